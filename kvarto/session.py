"""Session-level helpers: the shared checkpoint folder and checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that checkpoints go to.

    A cluster names a folder that all executors share in `spark.checkpoint.dir`; only where that is unset on a single
    machine (a local master, as in tests) a temporary folder is made.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="kvarto-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read from there, which also cuts its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_rows(df: DataFrame, limit: int) -> list | None:
    """All rows of `df` when there are at most `limit`, else None; never fetches more than limit + 1 rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def broadcast_checked(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` marked for broadcast if it has at most `max_rows` rows, else as it is (the join then shuffles)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
