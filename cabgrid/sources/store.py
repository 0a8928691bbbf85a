"""A trip table stored as parquet partitioned by pickup date.

Reading a date range then touches only the matching folders (partition
pruning) and the remaining predicates reach the parquet scan. Writing uses
the ``rebalance`` hint on the partition column: AQE splits a date holding a
large share of the trips into several tasks and merges small ones, so file
sizes stay even without a hand-chosen repartition count. Inside a file, trips
lie along a Z-curve over the grid of pickup cells: neighbours share row groups, whose
least and largest coordinates then let a read of a small area skip most of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cabgrid.functions.grid import grid_x, grid_y

DATE_COLUMN = "pickup_date"


def cell_curve(lon, lat, bits: int = 10) -> Column:
    """Place of a point's cell on a Z-curve: the bits of its column and row, interleaved.
    Points beyond the curve's square go to its border, a point without coordinates
    has no place (NULL)."""
    place = F.lit(0).cast("long")
    for shift, axis in enumerate((grid_x(lon), grid_y(lat))):
        axis = F.when(axis.isNotNull(), F.least(F.greatest(axis, F.lit(0)), F.lit(2**bits - 1))).cast("long")
        for b in range(bits):
            place = place + F.shiftleft(F.shiftright(axis, b).bitwiseAND(F.lit(1).cast("long")), 2 * b + shift)
    return place


def write_trip_table(trips: DataFrame, path: str, mode: str = "overwrite", row_group_bytes: int | None = None) -> None:
    """Write trips by pickup date, along the curve of pickup cells inside a file.
    ``overwrite`` replaces the dates that ``trips`` has and leaves all others as they
    are. Smaller row groups than the writer's own make finer areas to skip."""
    dated = trips.withColumn(DATE_COLUMN, F.to_date("pickup_dt"))
    rows = dated.hint("rebalance", DATE_COLUMN).sortWithinPartitions(DATE_COLUMN, cell_curve("pickup_long", "pickup_lat"))
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(DATE_COLUMN).parquet(path)


def read_trip_table(
    spark: SparkSession,
    path: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Trips with pickup date in [start, end] (either bound optional)."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(DATE_COLUMN) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(DATE_COLUMN) <= F.lit(end).cast("date"))
    return df.drop(DATE_COLUMN)
