"""Checks of elements against what their fields must be: dice codes and typical values, bonuses, cell counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: a dice formula with an addition, as a table gives it before its typical value
FORMULA = r"^(\d+)[Tt](\d+)\s*([+-]\s*\d+)?$"
NO_BONUS = ("—", "–", "-", "0", "")


def typical_value(formula: Column) -> Column:
    """The mean of a dice formula, halves rounded up; null for anything else."""
    part = lambda i: F.regexp_replace(F.regexp_extract(formula, FORMULA, i), " ", "").try_cast("int")
    return F.floor(part(1) * (part(2) + 1) / 2 + F.coalesce(part(3), F.lit(0)) + 0.5).cast("int")


def bonus(value: Column) -> Column:
    """A bonus in one form: no dash but 0, no plus sign, capitals."""
    bare = F.regexp_replace(F.trim(value), " ", "")
    return F.when(bare.isin(*NO_BONUS), "0").otherwise(F.upper(F.regexp_replace(bare, r"^\++", "")))


def uneven_rows(headers: Column, rows: Column) -> Column:
    """Numbers (from 1) of rows whose cells don't match the headers; none if every row has one cell more (a column of labels without a header)."""
    sizes = F.transform(rows, lambda r: F.coalesce(F.size(r), F.lit(0)))
    labelled = F.forall(sizes, lambda n: n == F.size(headers) + 1)
    uneven = F.filter(F.transform(sizes, lambda n, i: F.when(n != F.size(headers), i + 1)), lambda i: i.isNotNull())
    return F.when((F.size(headers) > 0) & (F.size(rows) > 0) & ~labelled, uneven).otherwise(F.array().cast("array<int>"))


def row_shapes(rows: Column) -> Column:
    """For each row `short`, `long` or `full` against the commonest number of cells of its table (the greater on ties)."""
    sizes = F.transform(rows, lambda r: F.coalesce(F.size(r), F.lit(0)))
    often = F.array_max(F.transform(F.array_distinct(sizes), lambda n: F.struct(F.size(F.filter(sizes, lambda m: m == n)).alias("often"), n.alias("n"))))["n"]
    return F.transform(sizes, lambda n: F.when(n < often, "short").when(n > often, "long").otherwise("full"))
