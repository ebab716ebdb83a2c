"""Printed lines as paragraphs: where one begins, and how two lines are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a line that fills less of its column ends a paragraph; one narrower than half the page's lines is a cell; a step to the right begins one
FULL_LINE, PROSE_LINE, INDENT, NEAR, BUCKET = 0.92, 0.5, 0.018, 0.04, 0.005
FIELD = r"^\p{Lu}[\p{L} ]{0,24}: "
HANGING = r"^(-|(och|eller|samt|respektive)\b)"
CAPITALS = r"\p{Lu}{2,}-$"


def local_columns(lines: DataFrame, page: list[str], key: str) -> DataFrame:
    """(key, column_x, column_w): the commonest left edge (in steps of 0.005, the least on ties) and the median width of the page's lines within 0.04 of each line.

    lines has key, x, w and the page columns; pairs are bounded by a page's lines.
    """
    own = lines.select(*page, key, F.col("x").alias("own_x"))
    near = own.join(lines.select(*page, "x", "w"), page).filter(F.round(F.abs(F.col("x") - F.col("own_x")), 6) <= NEAR)
    counted = near.withColumn("bucket", F.round(F.col("x") / BUCKET)).groupBy(key, "bucket").agg(F.count("*").alias("n"), F.collect_list("w").alias("ws"))
    modes = counted.groupBy(key).agg(F.min_by("bucket", F.struct(-F.col("n"), F.col("bucket"))).alias("bucket"), F.array_sort(F.flatten(F.collect_list("ws"))).alias("ws"))
    n = F.size("ws")
    middle = (F.element_at("ws", F.floor((n + 1) / 2).cast("int")) + F.element_at("ws", F.floor(n / 2).cast("int") + 1)) / 2
    return modes.select(key, F.round(F.col("bucket") * BUCKET, 6).alias("column_x"), F.round(middle, 6).alias("column_w"))


def open_hyphen(text: Column) -> Column:
    return F.endswith(text, F.lit("-")) & ~F.endswith(text, F.lit(" -")) & ~F.endswith(text, F.lit("--"))


def begins_paragraph(text: Column, before: Column, x: Column, before_x: Column, before_w: Column, after_x: Column, column_x: Column, before_column_w: Column, prose_w: Column) -> Column:
    """Whether a line begins a paragraph.

    A line `Label: value` does, and the first of a page; none does after a hyphen; without boxes every line does; so does one
    after a line that is no prose or doesn't fill its column, and one set in alone (an indent shared with a neighbour hangs).
    """
    less = lambda a, b: F.round(a - b, 6) < 0
    return (
        F.when(text.rlike(FIELD) | before.isNull(), True)
        .when(open_hyphen(F.rtrim(before)), False)
        .when(x.isNull() | before_x.isNull(), True)
        .when(less(before_w, PROSE_LINE * prose_w) | less(before_w, FULL_LINE * before_column_w), True)
        .when(less(x - column_x, F.lit(INDENT)), False)
        .when(less(F.abs(x - before_x), F.lit(INDENT)) | less(F.abs(after_x - x), F.lit(INDENT)), False)
        .otherwise(~less(x - column_x, F.lit(INDENT)))
    )


def joined(left: Column, right: Column) -> Column:
    """Two lines as one: a hyphen of division falls, that of a word left out or of a compound after capitals stays, a slash binds."""
    a, b = F.rtrim(left), F.ltrim(right)
    spaced, closed = F.concat(a, F.lit(" "), b), F.concat(F.substr(a, F.lit(1), F.length(a) - 1), b)
    lower = b.rlike(r"^\p{Ll}")
    hyphen = F.when(b.rlike(HANGING), spaced).when(lower & a.rlike(CAPITALS), F.concat(a, b)).when(lower | a.rlike(CAPITALS) & b.rlike(r"^\p{Lu}{2,}"), closed).otherwise(spaced)
    slash = F.endswith(a, F.lit("/")) & ~F.endswith(a, F.lit(" /")) & ~F.endswith(a, F.lit("//"))
    return F.when(a == "", b).when(b == "", a).when(open_hyphen(a), hyphen).when(slash, F.concat(a, b)).otherwise(spaced)


def folded_lines(lines: Column) -> Column:
    """An array of lines as one text."""
    return F.aggregate(lines, F.lit(""), joined)
