"""Incremental loading: delivered files with a quarantine, latest state of pages, sessions of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TYPES = ("heading", "paragraph", "boxed_text", "list", "list_item", "requirement", "table", "table_header", "table_cell", "table_caption", "table_note", "statblock", "toc_entry", "index_entry", "page_artifact", "illustration")
PAGE = "page INT, elements ARRAY<STRUCT<id STRING, type STRING, level INT, text STRING, confidence DOUBLE>>, skipped STRUCT<reason STRING>"


def first_error(value: Column) -> Column:
    """The first thing wrong with a delivered page (parsed by PAGE), null if nothing is."""
    elements = value["elements"]
    wrong_type = F.filter(elements, lambda e: ~F.coalesce(e["type"].isin(*TYPES), F.lit(False)))
    no_text = F.filter(elements, lambda e: e["type"].isin("heading", "paragraph", "boxed_text") & (F.coalesce(F.trim(e["text"]), F.lit("")) == ""))
    return (
        F.when(value.isNull(), "not JSON")
        .when(value["page"].isNull(), "no page number")
        .when(elements.isNull(), "no elements")
        .when((F.size(elements) == 0) & (F.coalesce(value["skipped"]["reason"], F.lit("")) != "illustration_only"), "empty without a reason")
        .when(F.size(wrong_type) > 0, "unknown type")
        .when(F.size(no_text) > 0, "element without text")
    )


def checked(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds `delivered` (the parsed page) and `error` to JSON texts; a byte order mark is dropped."""
    text = F.regexp_replace(F.col(column), "^﻿", "")
    return lines.withColumn("delivered", F.from_json(text, PAGE)).withColumn("error", F.when(F.try_parse_json(text).isNull(), "not JSON").otherwise(first_error(F.col("delivered"))))


def ingest(spark: SparkSession, source: str, accepted: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Loads all files not yet seen from a folder: valid pages as elements to one table, the rest with the reason to another.

    Each batch is written under its number, so a batch that is run again after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen = checked(batch).persist()
        good = seen.filter("error IS NULL").select("file", F.col("delivered.page").alias("page"), F.posexplode("delivered.elements").alias("idx", "e")).select("file", "page", "idx", "e.*")
        good.write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        seen.filter("error IS NOT NULL").select("file", "value", "error").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        seen.unpersist()

    stream = spark.readStream.format("text").option("wholetext", True).load(source).withColumn("file", F.col("_metadata.file_name"))
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(user_id, begin, end, n, value) of a stream's or a table's events; events later than `late` are left out of a stream."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    grouped = marked.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return grouped.select("user_id", F.col("s.start").alias("begin"), F.col("s.end").alias("end"), "n", "value")


def windowed_counts(events: DataFrame, size: str = "1 day", step: str | None = None, late: str = "1 day") -> DataFrame:
    """(begin, event_type, n, value) by tumbling windows, or sliding ones if a step is given."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    grouped = marked.groupBy(F.window("ts", size, step or size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return grouped.select(F.col("w.start").alias("begin"), "event_type", "n", "value")
