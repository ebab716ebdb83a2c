"""Keyed lookups into small reference tables: unique, by range, in a chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ambiguous_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that more than one row has: the build side of a unique lookup must have none."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def single_match(df: DataFrame, reference: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Left lookup that gives values only where exactly one reference row has the key."""
    counted = reference.select(key, *keep).withColumn("n__", F.count("*").over(Window.partitionBy(key))).filter("n__ = 1").drop("n__")
    return df.join(counted, key, "left")


def range_lookup(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str, keep: Sequence[str], max_bands: int = 10_000) -> DataFrame:
    """Adds the columns of the first band (least `low`) with low <= value <= high, null outside all.

    Bands that don't overlap, as a rule table's, match one row at most. The bands are broadcast only up to a checked number;
    more are cut into buckets about as wide as most bands and joined on the bucket.
    """
    b = bands.select(F.col(low).alias("low__"), F.col(high).alias("high__"), *keep)
    df = df.withColumn("value__", value)
    inside = F.col("value__").between(F.col("low__"), F.col("high__"))
    if b.limit(max_bands + 1).count() <= max_bands:
        return df.join(F.broadcast(b), inside, "left").drop("value__", "low__", "high__")
    width = b.select(F.percentile_approx(F.col("high__") - F.col("low__"), 0.9)).first()[0] or 1
    bucket = lambda c: F.floor(F.col(c) / F.lit(float(width)))
    cut = b.filter("low__ <= high__").withColumn("bucket__", F.explode(F.sequence(bucket("low__"), bucket("high__"))))
    return df.withColumn("at__", bucket("value__")).join(cut, (F.col("at__") == F.col("bucket__")) & inside, "left").drop("value__", "low__", "high__", "at__", "bucket__")


def term_index(lexicon: DataFrame, term: Column, canonical: Column) -> DataFrame:
    """(key, forms): each normalised key with its canonical forms in order; more than one is ambiguous."""
    return lexicon.select(term.alias("key"), canonical.alias("form")).filter("key IS NOT NULL AND form IS NOT NULL").groupBy("key").agg(F.array_sort(F.collect_set("form")).alias("forms"))
