"""Order statistics of large groups without gathering a group: from counts of distinct values."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(q: float) -> Callable[[Column], Column]:
    """Place (from 0) round-half-even(q * (n - 1)) among n sorted values."""
    return lambda n: F.bround(F.lit(q) * (n - 1)).cast("long")


def floored(q: float) -> Callable[[Column], Column]:
    """Place floor(q * n), at most the last."""
    return lambda n: F.least(F.floor(F.lit(q) * n), n - 1)


def order_statistics(df: DataFrame, groups: list[str], value: str, places: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """(groups.., n, one column for each place) of the values that aren't null; groups without values have no row.

    Rows are first counted by value, so what a task holds of a group is its distinct values: measured values have few.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("count__"))
    whole = Window.partitionBy(*groups)
    running = counted.withColumns({"n": F.sum("count__").over(whole), "upto__": F.sum("count__").over(whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))})
    here = lambda place: (place(F.col("n")) < F.col("upto__")) & (place(F.col("n")) >= F.col("upto__") - F.col("count__"))
    return running.groupBy(*groups).agg(F.max("n").alias("n"), *[F.max(F.when(here(p), F.col(value))).alias(name) for name, p in places.items()])
