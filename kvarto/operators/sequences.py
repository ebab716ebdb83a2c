"""Operators on ordered rows: clusters, runs, anchors, carried values, neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_clusters(df: DataFrame, groups: Sequence[str], x: str, gap: float, tie: Sequence[str], name: str = "cluster") -> DataFrame:
    """Numbers single-link clusters of `x` in each group from 1: a new one begins where the step from the row before exceeds `gap`."""
    w = Window.partitionBy(*groups).orderBy(x, *tie)
    new = F.coalesce((F.col(x) - F.lag(x).over(w) > gap).cast("int"), F.lit(1))
    return df.withColumn("new__", new).withColumn(name, F.sum("new__").over(w)).drop("new__")


def anchor_bands(df: DataFrame, groups: Sequence[str], y: str, tolerance: float, member: Sequence[str]) -> DataFrame:
    """(groups.., band, members): rows from top (greatest y) down; a band takes what is within `tolerance` of its first row.

    The first row is the reference, so the cut depends on the rows before: a fold over each group's sorted rows. A group is
    the part of one page, whose size the page bounds.
    """
    item = F.struct((-F.col(y)).alias("down"), *member)
    listed = df.filter(F.col(y).isNotNull()).groupBy(*groups).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = dict(listed.dtypes)["items"]
    start = F.struct(F.lit(0).alias("band"), F.lit(None).cast("double").alias("anchor"), F.array().cast(f"array<struct<band:int,item:{kind[6:-1]}>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = acc["anchor"].isNull() | (x["down"] - acc["anchor"] > tolerance)
        band = (acc["band"] + new.cast("int")).alias("band")
        return F.struct(band, F.when(new, x["down"]).otherwise(acc["anchor"]).alias("anchor"), F.array_append(acc["out"], F.struct(band, x.alias("item"))).alias("out"))

    out = F.aggregate("items", start, step, lambda acc: acc["out"])
    return listed.select(*groups, F.explode(out).alias("o")).select(*groups, "o.band", *[F.col(f"o.item.{m}").alias(m) for m in member])


def runs(df: DataFrame, groups: Sequence[str], order: Sequence[str], flag: Column, name: str = "run") -> DataFrame:
    """Numbers maximal runs of rows with an equal flag in each group, from 1."""
    w = Window.partitionBy(*groups).orderBy(*order)
    marked = df.withColumn("flag__", flag)
    change = F.coalesce((~F.col("flag__").eqNullSafe(F.lag("flag__").over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    return marked.withColumn("change__", F.when(first, 1).otherwise(change)).withColumn(name, F.sum("change__").over(w)).drop("flag__", "change__")


def carried(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Adds the last value that isn't null among this row and those before it."""
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def out_of_order(df: DataFrame, groups: Sequence[str], order: Sequence[str], y: str, slack: float = 0.05) -> DataFrame:
    """Rows whose height lies outside that of both neighbours by more than `slack` (y falls down the page)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    before, after = F.lag(y).over(w), F.lead(y).over(w)
    count = F.count("*").over(Window.partitionBy(*groups))
    marked = df.withColumns({"before__": before, "after__": after, "count__": count})
    bad = (F.col("count__") >= 3) & ((F.col(y) > F.col("before__") + slack) | (F.col(y) < F.col("after__") - slack))
    return marked.filter(bad).drop("before__", "after__", "count__")


def rolling_range(df: DataFrame, groups: Sequence[str], order: Sequence[str], x: str, reach: int) -> DataFrame:
    """Adds the least and greatest value of `x` from `reach` rows before to `reach` rows after."""
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(-reach, reach)
    return df.withColumns({"low": F.min(x).over(w), "high": F.max(x).over(w)})


def embedded_rows(elements: DataFrame, longest: int = 28) -> DataFrame:
    """(book, page, run, cells, n): runs of two or more embedded texts with the same number of lines, at least two and none longer than `longest`, as cells of table rows.

    Needs book, page, idx, element_key, text, method; null texts are passed over.
    """
    lines = F.split("text", "\n")
    cells = F.when((F.col("method") == "embedded") & (F.size(lines) >= 2) & (F.array_max(F.transform(lines, lambda x: F.length(x))) <= longest), F.size(lines)).otherwise(0)
    marked = runs(elements.filter("text IS NOT NULL").withColumn("cells", cells), ["book", "page"], ["idx", "element_key"], F.col("cells"))
    return marked.filter("cells > 0").groupBy("book", "page", "run").agg(F.max("cells").alias("cells"), F.count("*").alias("n")).filter("n >= 2")
