"""Reading base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """One Parquet table per name; Spark prunes columns and pushes filters per use."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
