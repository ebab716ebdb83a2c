"""Rules over a whole book: what changes from its first pages to its last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ceased_types(elements: DataFrame, least: int = 5, silent: int = 8) -> DataFrame:
    """(book, type, pages, last, silent): types on at least `least` pages and then no more, with the number of prose pages that follow, `silent` or more.

    Needs book, page, type.
    """
    types = elements.groupBy("book", "type").agg(F.count_distinct("page").alias("pages"), F.max("page").alias("last")).filter(F.col("pages") >= least)
    # prose pages after each page by a running count from the end, instead of pairing types with pages
    prose = elements.filter("type = 'paragraph'").select("book", "page").distinct()
    later = elements.select("book", "page").distinct().join(prose.withColumn("is", F.lit(1)), ["book", "page"], "left")
    w = Window.partitionBy("book").orderBy(F.desc("page")).rowsBetween(Window.unboundedPreceding, -1)
    later = later.select("book", F.col("page").alias("last"), F.coalesce(F.sum("is").over(w), F.lit(0)).alias("silent"))
    return types.join(later, ["book", "last"]).filter(F.col("silent") >= silent).select("book", "type", "pages", "last", "silent")


def retyped_furniture(elements: DataFrame, least: int = 3, body: int = 5, longest: int = 60) -> DataFrame:
    """(book, text, pages, types): a page's topmost text of at most `longest` characters that stands on `least` pages under two types or more; pages with fewer than `body` elements are passed over.

    Needs book, page, idx, text, type, y.
    """
    e = elements.filter("y IS NOT NULL").withColumn("size", F.count("*").over(Window.partitionBy("book", "page"))).filter((F.length("text") <= longest) & (F.col("size") >= body))
    top = e.groupBy("book", "page").agg(F.min_by(F.struct("text", "type"), F.struct(-F.col("y"), F.col("idx"))).alias("t")).select("book", "page", "t.*")
    return top.groupBy("book", "text").agg(F.count("*").alias("pages"), F.array_sort(F.collect_set("type")).alias("types")).filter((F.col("pages") >= least) & (F.size("types") >= 2))


def interleaved(elements: DataFrame, least: int = 5, share: float = 0.8) -> DataFrame:
    """Elements of the second column that stand before at least `share` of the first one, where both have `least` elements.

    Needs book, page, idx, element_key, region; regions other than `kolumn 1` and `kolumn 2` are passed over.
    """
    e = elements.filter("region IN ('kolumn 1', 'kolumn 2')")
    first = (F.col("region") == "kolumn 1").cast("int")
    page = Window.partitionBy("book", "page")
    after = page.orderBy("idx").rowsBetween(1, Window.unboundedFollowing)
    n = e.withColumns({"firsts": F.sum(first).over(page), "all": F.count("*").over(page), "after": F.coalesce(F.sum(first).over(after), F.lit(0))})
    enough = (F.col("firsts") >= least) & (F.col("all") - F.col("firsts") >= least)
    return n.filter(enough & (F.col("region") == "kolumn 2") & (F.col("after") >= share * F.col("firsts"))).select("element_key")
