"""Bags of words: counts, differences, and what changes account for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvarto.functions.text import tokens


def word_bag(df: DataFrame, text: Column, groups: Sequence[str] = ()) -> DataFrame:
    """(groups.., word, n): occurrences of each word, without list markers."""
    return df.select(*groups, F.explode(tokens(text)).alias("word")).groupBy(*groups, "word").agg(F.count("*").alias("n"))


def bag_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys.., lost, gained) of two bags (keys.., n): what only the left or only the right one has, in one shuffle."""
    both = left.select(*keys, F.col("n").alias("d")).unionByName(right.select(*keys, (-F.col("n")).alias("d")))
    net = both.groupBy(*keys).agg(F.sum("d").alias("d")).filter("d <> 0")
    return net.select(*keys, F.greatest("d", F.lit(0)).alias("lost"), F.greatest(-F.col("d"), F.lit(0)).alias("gained"))


def unexplained(difference: DataFrame, credited: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys.., lost, gained) that remain when credited (keys.., lost, gained) is taken off, never below nothing."""
    c = credited.groupBy(*keys).agg(F.sum("lost").alias("c_lost"), F.sum("gained").alias("c_gained"))
    rest = difference.join(c, list(keys), "left")
    left = lambda a, b: F.greatest(F.col(a) - F.coalesce(F.col(b), F.lit(0)), F.lit(0))
    return rest.select(*keys, left("lost", "c_lost").alias("lost"), left("gained", "c_gained").alias("gained")).filter("lost > 0 OR gained > 0")
