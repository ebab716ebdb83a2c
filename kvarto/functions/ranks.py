"""Order statistics that differ from the built-in percentiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sorted(x: Column) -> Column:
    return F.array_sort(F.collect_list(x))


def nearest_rank(x: Column, q: float) -> Column:
    """The element at round-half-even(q * (n - 1)) of the sorted values; null when there are none."""
    s = _sorted(x)
    return F.get(s, F.bround(F.lit(q) * (F.size(s) - 1)).cast("int"))


def floor_rank(x: Column, q: float) -> Column:
    """The element at floor(q * n), at most the last one."""
    s = _sorted(x)
    return F.get(s, F.least(F.floor(F.lit(q) * F.size(s)), F.size(s) - 1).cast("int"))


def upper_median(x: Column) -> Column:
    """The middle element, of two the greater."""
    return floor_rank(x, 0.5)
