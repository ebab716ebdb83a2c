"""Free names of page regions brought to measured ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FURNITURE = ("sidhuvud", "sidfot", "marginal")
FULL_WIDTH = "helbredd"


def washed(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))


def column_references(name: Column) -> Column:
    """The distinct columns that a name points out: 'nr2', 'vänster', 'mitt', 'höger'."""
    r = washed(name)
    numbered = F.transform(F.regexp_extract_all(r, F.lit(r"(?:kolumn|spalt)\s*(\d+)"), 1), lambda n: F.concat(F.lit("nr"), n))
    named = F.array_compact(F.array(*[F.when(r.rlike(p), F.lit(n)) for n, p in (("vänster", "vänster"), ("mitt", "mitt(en|ersta)?( ?kolumn| ?spalt)"), ("höger", "höger"))]))
    return F.array_distinct(F.concat(numbered, named))


def column_count(references: Column) -> Column:
    """The number of columns that all names of a page speak of (an array of references), null if of none."""
    highest = F.coalesce(F.array_max(F.transform(F.filter(references, lambda r: r.startswith("nr")), lambda r: F.substring(r, 3, 9).cast("int"))), F.lit(0))
    named = F.when(F.array_contains(references, "vänster") & F.array_contains(references, "höger"), F.when(F.array_contains(references, "mitt"), 3).otherwise(2)).otherwise(0)
    count = F.greatest(highest, named)
    return F.when(count > 0, count)


def normalised(name: Column, columns: Column, transcript_columns: Column) -> Column:
    """The measured region meant by a name, or null: furniture by its beginning, the whole width, else exactly one column.

    `columns` are a page's measured columns from left to right; where their number isn't the transcript's, no column is named.
    """
    r, refs = washed(name), column_references(name)
    furniture = F.coalesce(*[F.when(r.startswith(f), F.lit(f)) for f in FURNITURE])
    ref = F.get(refs, F.lit(0))
    n = F.size(columns)
    index = F.when(ref.startswith("nr"), F.substring(ref, 3, 9).cast("int") - 1).when(ref == "vänster", 0).when(ref == "höger", n - 1).when(n == 3, 1)
    agree = transcript_columns.isNull() | (transcript_columns == n)
    column = F.when((F.size(refs) == 1) & agree & (n > 0), F.get(columns, index))
    return F.coalesce(furniture, F.when(F.size(refs) > 1, F.lit(None).cast("string")).when(r.rlike("helbredd|hela sidan|full bredd"), FULL_WIDTH).otherwise(column))


def column_starts(lefts: Column, gap: int) -> Column:
    """Where columns start among sorted left edges: a new one begins where the distance from the last start exceeds `gap`."""
    none = F.slice(lefts, 1, 0)
    return F.aggregate(lefts, none, lambda acc, x: F.when((F.size(acc) == 0) | (x - F.element_at(acc, -1) > gap), F.array_append(acc, x)).otherwise(acc))
