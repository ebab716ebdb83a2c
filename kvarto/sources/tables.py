"""Parquet table reader: one place that turns (directory, name) into a DataFrame."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data directory, read with the file's own schema."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
