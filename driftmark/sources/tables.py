"""Reading the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftmark.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; column pruning and filters reach the scan."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
