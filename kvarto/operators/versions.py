"""Choice of one version per key: newest, or best by a stage's rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the order in which stored stages are preferred
MERGE_ORDER = ("final", "validated", "transcript", "embedded")
SOURCE_ORDER = ("final", "transcript", "embedded")
STATE_ORDER = {"pending": 0, "rendered": 1, "extracted": 1, "transcribed": 2, "validated": 3, "reviewed": 4, "final": 5}


def best_row(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row of each key with the least `order` (a struct); combined before the shuffle, so a hot key costs no more than others."""
    packed = df.select(*keys, F.struct(*df.columns).alias("row"), order.alias("order"))
    return packed.groupBy(*keys).agg(F.min_by("row", "order").alias("row")).select("row.*")


def newest(df: DataFrame, keys: Sequence[str], version: str, tie: str) -> DataFrame:
    """The row of each key with the greatest version; null versions come last, ties go to the least `tie`."""
    seconds = F.coalesce(-F.unix_micros(F.col(version)), F.lit(2**62))
    return best_row(df, keys, F.struct(seconds, F.col(tie)))


def stage_rank(stage: Column, order: Sequence[str]) -> Column:
    """0 for the most preferred stage; null for one that isn't in the order."""
    at = F.array_position(F.array(*[F.lit(s) for s in order]), stage)
    return F.when(at > 0, at - 1)


def best_stage(df: DataFrame, keys: Sequence[str], order: Sequence[str], version: str, tie: str) -> DataFrame:
    """The row of each key in the most preferred stage, the newest of these."""
    known = df.filter(F.col("stage").isin(*order))
    seconds = F.coalesce(-F.unix_micros(F.col(version)), F.lit(2**62))
    return best_row(known, keys, F.struct(stage_rank(F.col("stage"), order), seconds, F.col(tie)))


def at_least(state: Column, wanted: str) -> Column:
    """Whether a state has come as far as the wanted one; an unknown state is the least."""
    levels = F.create_map(*[F.lit(x) for kv in STATE_ORDER.items() for x in kv])
    return F.coalesce(F.try_element_at(levels, state), F.lit(0)) >= STATE_ORDER[wanted]
