"""Splitting of elements that hold several paragraphs, at the indents of their measured rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INDENT, DEEPEST, RAGGED = 0.008, 0.035, 0.92


def suffix(n: Column) -> Column:
    """a, b, .. z, aa, .. zz, aaa, .. for 0, 1, .. (fourteen letters count all 64-bit numbers)."""
    start = F.struct(n.cast("long").alias("left"), F.lit("").alias("text"))

    def step(acc: Column, _: Column) -> Column:
        letter = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), (acc["left"] % 26 + 1).cast("int"), F.lit(1))
        more = acc["left"] >= 0
        return F.struct(F.when(more, F.floor(acc["left"] / 26) - 1).otherwise(F.lit(-1)).cast("long").alias("left"), F.when(more, F.concat(letter, acc["text"])).otherwise(acc["text"]).alias("text"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, step, lambda acc: acc["text"])


def break_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, place) of rows that begin a paragraph inside an element: (key, place, text, x, w) with one row for each printed line.

    A row is a beginning when it is indented against the element's usual left edge, the row before ends short or in a closing
    mark, and that row doesn't end in a hyphen. Elements of which every later row is indented have a hanging first line.
    """
    whole = Window.partitionBy(key)
    w = whole.orderBy("place")
    marked = rows.withColumns({"base": F.median("x").over(whole), "full": F.max("w").over(whole), "p_text": F.lag("text").over(w), "p_w": F.lag("w").over(w), "first": F.min("place").over(whole)})
    indent = F.round(F.col("x") - F.col("base"), 6).between(INDENT, DEEPEST)
    ended = (F.round(F.col("p_w") - RAGGED * F.col("full"), 6) < 0) | F.col("p_text").rlike(r"[.!?:”\"]$")
    begins = (F.col("place") > F.col("first")) & indent & ended & ~F.col("p_text").endswith("-")
    hanging = F.min(F.when(F.col("place") > F.col("first"), indent)).over(whole)
    return marked.withColumn("hanging", hanging).filter(F.coalesce(begins & ~F.coalesce("hanging", F.lit(False)), F.lit(False))).select(key, "place")


def split_elements(rows: DataFrame, breaks: DataFrame, key: str, ident: str) -> DataFrame:
    """(key, new id, part, text) of each element's parts; the parts' lines put together are the element's lines."""
    w = Window.partitionBy(key).orderBy("place")
    part = F.sum(F.coalesce(F.col("is__"), F.lit(0))).over(w)
    numbered = rows.join(breaks.withColumn("is__", F.lit(1)), [key, "place"], "left").withColumn("part", part)
    texts = numbered.groupBy(key, ident, "part").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("l"))
    several = F.max("part").over(Window.partitionBy(key)) > 0
    return texts.select(key, F.when(several, F.concat(F.col(ident), suffix(F.col("part")))).otherwise(F.col(ident)).alias("new_id"), "part", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))


def agreement(found: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many of the found keys are true, false, and how many true ones weren't found."""
    both = found.select(*keys).distinct().withColumn("f", F.lit(1)).join(truth.select(*keys).distinct().withColumn("t", F.lit(1)), list(keys), "full")
    return both.agg(F.count_if(F.col("f").isNotNull() & F.col("t").isNotNull()).alias("right"), F.count_if(F.col("t").isNull()).alias("wrong"), F.count_if(F.col("f").isNull()).alias("missed"))
