"""Repair of dice codes: all readings of a token, the one with the fewest changes if it is alone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: what a recognised character may stand for
MISREAD = {
    "+": ["T", "+"], "7": ["T", "7"], "A": ["4"], "B": ["8", "3"], "D": ["T"], "G": ["6"], "I": ["1", "T"], "O": ["0"], "Q": ["0"], "S": ["5"], "Z": ["2"], "b": ["6"], "d": ["T"], "g": ["9"],
    "i": ["1"], "l": ["1", "T"], "o": ["0"], "q": ["9"], "s": ["5"], "t": ["T"], "z": ["2"], "|": ["1", "T"],
}
SIDES = ("2", "3", "4", "6", "8", "10", "12", "20", "100")
CODE = r"^(\d+)T(\d+)([+\-–]\d+)?$"
#: at most so many readings of a token are looked at; a token with more is none
MOST_READINGS = 400


def shape() -> str:
    """Java pattern of tokens that can be a dice code: figures, T and what recognition may make of them, perhaps with an addition."""
    chars = "".join(re.escape(c) for c in dict.fromkeys([*"0123456789TtDd", *MISREAD]))
    figures = "".join(re.escape(c) for c in dict.fromkeys([*"0123456789", *(k for k, v in MISREAD.items() if any(x.isdigit() for x in v))]))
    return rf"^[{chars}]{{2,7}}([+\-–][{figures}]{{1,2}})?$"


def _options(ch: Column) -> Column:
    table = F.create_map(*[x for k, v in MISREAD.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    own = F.when(ch.rlike(r"[\d+\-–]"), F.array(ch)).when(ch.rlike("[TtDd]"), F.array(F.lit("T"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(own, F.coalesce(F.try_element_at(table, ch), F.array().cast("array<string>"))))


def _changes(token: Column, reading: Column) -> Column:
    chars = F.arrays_zip(F.split(token, "").alias("a"), F.split(reading, "").alias("b"))
    return F.size(F.filter(chars, lambda p: p["a"] != p["b"]))


def repair(tokens: DataFrame, column: str) -> DataFrame:
    """Adds status (ok, fixed, ambiguous, invalid, skip), repaired and changes to each distinct token's row.

    Whole numbers are never repaired; a token without a figure needs a T or D of its own; of the code's part before a sign at
    least one figure or T must stand as it was. Two best readings make a token ambiguous. Null tokens are skipped. The
    confidence of a repair is 1 less .03 for each change, at least .85; from .9 it may be applied.
    """
    t = F.col(column)
    valid = lambda c: c.rlike(CODE) & F.regexp_extract(c, CODE, 2).isin(*SIDES) & F.coalesce(F.regexp_extract(c, CODE, 1).try_cast("int").between(1, 30), F.lit(False))
    possible = F.length(t).between(2, 9) & ~t.rlike(r"^\d+$") & t.rlike(r"[\dTtDd]")
    df = tokens.withColumn("options__", F.when(possible, F.transform(F.split(t, ""), _options)))
    product = F.aggregate("options__", F.lit(1.0), lambda n, o: n * F.size(o))
    df = df.withColumn("options__", F.when((product > 0) & (product <= MOST_READINGS), F.col("options__")))
    all_readings = F.aggregate("options__", F.array(F.lit("")), lambda acc, o: F.flatten(F.transform(acc, lambda a: F.transform(o, lambda c: F.concat(a, c)))))
    df = df.withColumn("readings__", F.array_sort(F.transform(F.filter(all_readings, valid), lambda r: F.struct(_changes(t, r).alias("changes"), r.alias("code")))))
    best, second = F.get("readings__", F.lit(0)), F.get("readings__", F.lit(1))
    core = F.regexp_extract(best["code"], r"^[^+\-–]+", 0)
    kept = F.exists(F.arrays_zip(F.split(t, "").alias("a"), F.split(core, "").alias("b")), lambda p: p["a"].eqNullSafe(p["b"]) & F.coalesce(p["a"].rlike(r"[\dTtDd]"), F.lit(False)))
    looks = F.coalesce(t.rlike(r"^\d+[Tt]\d+([+\-–]\d+)?$"), F.lit(False))
    status = (
        F.when(F.coalesce(valid(t), F.lit(False)), "ok").when(best.isNull() & looks, "invalid").when(best.isNull(), "skip")
        .when(second["changes"] == best["changes"], "ambiguous").when(~kept, "ambiguous").otherwise("fixed")
    )
    out = df.withColumn("status", status).withColumn("repaired", F.when(F.col("status") == "fixed", best["code"])).withColumn("changes", F.when(F.col("status") == "fixed", best["changes"]))
    return out.withColumn("confidence", F.when(F.col("status") == "fixed", F.greatest(F.lit(0.85), F.lit(1.0) - 0.03 * F.col("changes")))).drop("options__", "readings__")
