"""Correction records: checks of records, folding them into texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("ocr", "emendering")
VERDICTS = ("applicerad", "avvisad")
#: from this confidence on a record is applied unless it says otherwise
APPLY = 0.9


def with_defaults(records: DataFrame) -> DataFrame:
    """Records with what may be left out filled in: applied by confidence, kind ocr, confidence of three decimals."""
    return records.withColumns({"applied": F.coalesce("applied", F.col("confidence") >= APPLY, F.lit(False)), "kind": F.coalesce("kind", F.lit("ocr")), "confidence": F.round("confidence", 3)})


def violations(records: DataFrame, key: str) -> DataFrame:
    """(key, problem) of records that contradict themselves; a record may have several problems."""
    problem = {
        "confidence out of range": ~F.col("confidence").between(0, 1),
        "unknown kind": ~F.col("kind").isin(*KINDS),
        "unknown verdict": ~F.col("verdict").isin(*VERDICTS),
        "applied without text": F.col("applied") & F.col("corrected").isNull(),
        "applied but rejected": F.col("applied") & (F.col("verdict") == "avvisad"),
        "changes nothing": F.col("original") == F.col("corrected"),
    }
    listed = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in problem.items()]))
    return records.select(key, F.explode(listed).alias("problem"))


def _quoted(word: Column) -> Column:
    return F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))


def fold(text: Column, changes: Column) -> Column:
    """The text after whole-word replacement by each change (original, corrected) in turn; empty originals are passed over."""
    safe = lambda c: F.regexp_replace(F.coalesce(c["corrected"], F.lit("")), r"([\\$])", r"\\$1")
    step = lambda t, c: F.when(F.coalesce(c["original"], F.lit("")) == "", t).otherwise(F.regexp_replace(t, _quoted(c["original"]), safe(c)))
    return F.aggregate(changes, text, step)


def apply_records(elements: DataFrame, records: DataFrame, key: str, order: str) -> DataFrame:
    """Elements with the applied records of their key folded into `text`; `before` keeps the text as it was.

    Records are gathered by key before the join; a key's records are those of one element.
    """
    chosen = with_defaults(records).filter("applied AND corrected IS NOT NULL AND original IS NOT NULL")
    gathered = chosen.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "original", "corrected"))).alias("changes__"))
    joined = elements.join(gathered, key, "left")
    return joined.withColumn("before", F.col("text")).withColumn("text", F.when(F.col("changes__").isNotNull(), fold(F.col("text"), F.col("changes__"))).otherwise(F.col("text"))).drop("changes__")
