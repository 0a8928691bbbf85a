"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabgrid.session import checkpoint_root

#: Text that Spark hands to a Python worker at once, unless the session says otherwise.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python workers by bytes: ten thousand long texts
    in a batch (the default bound is 64 MB) are held by Spark and by the worker."""
    if spark.conf.get(_BATCH_SETTING, "67108864b") in ("67108864b", "64m", "67108864"):
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage
    ends here, so a lost executor costs no recomputation of what came before."""
    return _write(df, f"{checkpoint_root(df.sparkSession)}/cabgrid-llm/{uuid.uuid4().hex}/{name}")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one operator's run, in a folder that goes when the run is over:

    ``with Scratch(spark) as keep: step = keep(df, "step")``; the result is
    :func:`saved`, or doesn't read those tables."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{checkpoint_root(spark)}/cabgrid-llm/{uuid.uuid4().hex}"
        self.tables = 0

    def __enter__(self) -> Callable[[DataFrame, str], DataFrame]:
        return self.keep

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        return _write(df, f"{self.folder}/{self.tables}-{name}")

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
