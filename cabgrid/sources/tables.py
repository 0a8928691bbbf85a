"""Parquet table access."""

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``{root}/{name}.parquet``. Column pruning and filter pushdown
    happen in the scan, so callers select only what they use."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
