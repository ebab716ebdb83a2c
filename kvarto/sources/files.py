"""Readers of other files: JSON pages, checksummed catalogues, question queues in markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.streaming.ingest import checked


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, delivered, error) of the JSON page files of a folder, checked one by one."""
    return checked(spark.read.option("wholetext", True).text(path).withColumn("file", F.col("_metadata.file_name")))


def verified(spark: SparkSession, path: str, checksums: DataFrame) -> DataFrame:
    """(file, sha256, expected, ok) of every file of a folder and every expected one; a missing or changed file isn't ok."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha256"))
    return files.join(checksums.select("file", F.col("sha256").alias("expected")), "file", "full").withColumn("ok", F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False)))


def adapters(spark: SparkSession, path: str) -> DataFrame:
    """(adapter, part, json) of the JSON files of every adapter folder under `path`: folders that hold a system.json and don't begin with an underscore.

    A part that an adapter lacks has no row; a lookup in it finds nothing.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    parts = F.split(F.col("_metadata.file_path"), "/")
    named = files.select(F.element_at(parts, -2).alias("adapter"), F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("part"), F.regexp_replace("value", "^\ufeff", "").alias("json"))
    whole = named.filter("part = 'system' AND NOT startswith(adapter, '_')").select("adapter").distinct()
    return named.join(whole, "adapter", "left_semi")


def with_measured_rows(elements: DataFrame, rows: DataFrame) -> DataFrame:
    """`elements` with `measured`, the rows (row_idx, x, y, w, h) measured on their page in order, null where a page has none."""
    pages = rows.groupBy("book", "page").agg(F.array_sort(F.collect_list(F.struct("row_idx", "x", "y", "w", "h"))).alias("measured"))
    return elements.join(pages, ["book", "page"], "left")


def item_class(text: Column) -> Column:
    """The class that a question names in brackets, `beslut` or `verktyg`; `beslut` if it names none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^\s*\[(beslut|verktyg)\]", 1), F.lit("")), F.lit("beslut"))


def queue_items(lines: DataFrame, heading: str) -> DataFrame:
    """(file, item, text) of open items `- [ ] ID text` under one heading; indented lines continue an item.

    Needs (file, line, text); a file's lines are ordered by `line`.
    """
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    under = F.last(F.when(F.col("text").startswith("#"), F.trim(F.regexp_replace("text", "^#+", ""))), ignorenulls=True).over(w)
    marked = lines.withColumn("under", under).withColumn("start", F.col("text").rlike(r"^- \[[ x]\] ")).withColumn("number", F.sum(F.col("start").cast("int")).over(w))
    kept = marked.filter((F.col("under") == heading) & (F.col("start") | F.col("text").rlike(r"^\s+\S")) & (F.col("number") > 0))
    listed = kept.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("l"))
    whole = F.array_join(F.transform("l", lambda x: F.trim(x["text"])), " ")
    open_items = listed.filter(F.col("l")[0]["text"].startswith("- [ ] ")).select("file", F.regexp_replace(whole, r"^- \[ \] ", "").alias("body"))
    return open_items.select("file", F.regexp_extract("body", r"^(\S+)", 1).alias("item"), F.trim(F.regexp_replace("body", r"^\S+", "")).alias("text"))
