"""Streaming trip sources.

Event-time columns of a stream are TIMESTAMP (``withWatermark`` rejects
TIMESTAMP_NTZ); run with ``spark.sql.session.timeZone=UTC`` so windows align
with the batch queries, which work on TIMESTAMP_NTZ wall-clock time.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from cabgrid.operators.clean import clean_trips
from cabgrid.schema import TRIP_SCHEMA
from cabgrid.sources.lines import parse_trips

EVENT_TIME_COLUMNS = ("pickup_dt", "dropoff_dt")


UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00"}


def to_event_time(trips: DataFrame) -> DataFrame:
    """TIMESTAMP_NTZ -> TIMESTAMP for the watermark (identity under UTC).

    Windows on TIMESTAMP align to UTC; in another session zone daily windows
    would start at UTC midnight instead of wall-clock midnight and differ
    from the batch queries, hence the warning."""
    zone = trips.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    if zone not in UTC_ZONES:
        warnings.warn(
            f"session time zone is {zone}; streaming windows align to UTC, set "
            "spark.sql.session.timeZone=UTC to match the batch results",
            stacklevel=2,
        )
    return trips.withColumns({c: F.col(c).cast("timestamp") for c in EVENT_TIME_COLUMNS if c in trips.columns})


def to_wall_clock(df: DataFrame, cols: list[str]) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ for results, matching the batch types."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def read_trip_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Trips from files landing in ``path``: ``text`` lines (the comma
    layout, gzip allowed) or ``parquet`` trip rows. Rows are parsed,
    cleaned, given grid cells and event-time columns."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        trips = parse_trips(reader.text(path))
    elif fmt == "parquet":
        trips = reader.schema(TRIP_SCHEMA).parquet(path)
    else:
        raise ValueError(f"unsupported stream format {fmt!r}")
    return to_event_time(clean_trips(trips))


def trips_of_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Trips from messages whose (binary or text) ``value`` is a trip line, as a
    Kafka topic delivers them: the value is kept, keys and offsets are not."""
    lines = messages.select(F.col(value_col).cast("string").alias("value"))
    return to_event_time(clean_trips(parse_trips(lines)))


def read_trip_stream_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
) -> DataFrame:
    """Trips from a Kafka topic whose message values are trip lines. Needs
    the Spark Kafka connector on the classpath; without it a clear error is
    raised instead of a bare class-not-found."""
    try:
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
        )
    except AnalysisException as e:  # data source not found
        raise RuntimeError(
            "Kafka source unavailable: add the spark-sql-kafka connector package to the session"
        ) from e
    return trips_of_messages(raw)
