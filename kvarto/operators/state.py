"""What lasts between runs: published tables, snapshots, queues, stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.functions.text import normalise
from kvarto.operators.bags import bag_difference, word_bag


def publish_text(df: DataFrame, path: str, names: list[str], text: str) -> None:
    """Writes a text column as files in folders by `names`; the commit protocol shows all files of a run or none."""
    df.select(*names, F.col(text).alias("value")).write.mode("overwrite").partitionBy(*names).text(path)


def freeze(df: DataFrame, path: str, version: str) -> None:
    """A snapshot of a table under a version name; a version that exists is not overwritten."""
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")


def drift(spark: SparkSession, path: str, before: str, after: str, keys: list[str], text: str) -> DataFrame:
    """(keys.., word, lost, gained) between two snapshots."""
    bag = lambda v: word_bag(spark.read.parquet(f"{path}/version={v}"), F.col(text), keys)
    return bag_difference(bag(before), bag(after), [*keys, "word"])


def enqueue(queue: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of `new` (text, class) that the queue doesn't hold yet, case and accents aside, each once; running it again adds nothing."""
    keyed = new.filter("text IS NOT NULL").withColumn("key__", normalise(F.col("text"))).groupBy("key__").agg(F.min(F.struct("text", "class")).alias("r"))
    return keyed.join(queue.select(normalise(F.col("text")).alias("key__")), "key__", "left_anti").select("r.*")


def stamped(df: DataFrame, revision: str, schema_version: int, at: Column) -> DataFrame:
    """Rows with the revision, schema version and time of the run that made them."""
    return df.withColumn("made_by", F.struct(F.lit(revision).alias("revision"), F.lit(schema_version).alias("schema_version"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at")))
