"""Streaming queries as ``(spark, table_dir) -> DataFrame`` callables.

Each call reads the ``events`` table of ``table_dir`` as a stream with a
declared schema, derives the trips inside the streaming plan, runs the query
until all input is used (``availableNow``) and returns what it wrote. The input
ends with a flush event, far in the future and of a taxi of its own: it moves
the watermark past every window of the table, so all of them are emitted, while
its own never close. Checkpoints and outputs live under the session's shared
checkpoint folder, in a new folder for every call.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cabgrid.operators import clean_trips
from cabgrid.plans.catalog import spoilt_lines
from cabgrid.schema import TOP_K
from cabgrid.session import checkpoint_root
from cabgrid.sources import trips_from_events
from cabgrid.streaming import (
    best_so_far,
    drivers_order,
    pleasant_drivers_of_batch,
    stream_cell_rendezvous,
    stream_cell_rendezvous_compat,
    stream_congestion_alerts,
    stream_driver_tips,
    read_best,
    routes_order,
    stream_idle_alerts,
    stream_idle_alerts_sliding,
    stream_idle_compat,
    stream_outcomes,
    stream_profitable_areas,
    stream_route_counts,
    to_event_time,
    top_routes_of_batch,
    write_stream,
)

EVENT_COLUMNS = "event_id long, ts timestamp_ntz, user_id long, value double"
#: An event that cleaning keeps, of a taxi (user -5: M-1) that the table hasn't.
FLUSH_EVENT = (0, dt.datetime(2200, 1, 1), -5, 0.0)


def event_stream(spark: SparkSession, table_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a stream."""
    reader = spark.readStream.schema(EVENT_COLUMNS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A pattern, since a table may be one file: as a plain path a source takes folders only.
    return reader.parquet(f"{table_dir.rstrip('/')}/event[s].parquet")


def trip_stream(spark: SparkSession, table_dir: str, scratch: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Cleaned trips of the ``events`` table as a stream that ends with the flush
    event (a file in ``scratch``)."""
    spark.createDataFrame([FLUSH_EVENT], EVENT_COLUMNS).write.parquet(f"{scratch}/flush")
    flush = spark.readStream.schema(EVENT_COLUMNS).parquet(f"{scratch}/flush")
    events = event_stream(spark, table_dir, max_files_per_trigger).unionByName(flush)
    return to_event_time(clean_trips(trips_from_events(events)))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/cabgrid-stream/{uuid.uuid4().hex}/{name}"


def _finished(name: str, query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {query.exception()}")


def _stream(name: str, build, per_batch=None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, table_dir: str) -> DataFrame:
        scratch = _scratch(spark, name)
        result = build(trip_stream(spark, table_dir, scratch))
        _finished(name, write_stream(result, f"{scratch}/out", f"{scratch}/checkpoint", per_batch=per_batch, available_now=True))
        out = spark.read.parquet(f"{scratch}/out")
        return out.drop("batch_id") if per_batch else out

    run.__name__ = name
    return run


def _overall(name: str, build, order) -> Callable[[SparkSession, str], DataFrame]:
    """The best rows of the whole stream, kept up with every micro-batch."""

    def run(spark: SparkSession, table_dir: str) -> DataFrame:
        scratch = _scratch(spark, name)
        result, out = build(trip_stream(spark, table_dir, scratch)), f"{scratch}/out"
        _finished(name, write_stream(result, out, f"{scratch}/checkpoint", per_batch=best_so_far(out, order, TOP_K), available_now=True))
        return read_best(spark, out)

    run.__name__ = name
    return run


def stream_reject_counts(spark: SparkSession, table_dir: str) -> DataFrame:
    """Lines by outcome of a stream of lines that is written with its dead letters."""
    scratch = _scratch(spark, "stream_reject_counts")
    lines = spoilt_lines(trips_from_events(event_stream(spark, table_dir)))
    done = stream_outcomes(lines, id_col="event_id")
    _finished("stream_reject_counts", write_stream(done, f"{scratch}/out", f"{scratch}/checkpoint", available_now=True, partition_by=["outcome"]))
    written = spark.read.schema(done.schema).parquet(f"{scratch}/out")
    return written.groupBy("outcome").agg(F.count(F.lit(1)).alias("num_lines"))


#: Query, and what is done with the windows that close in a micro-batch.
BUILDERS: dict[str, tuple[Callable[..., DataFrame], Callable[[DataFrame], DataFrame] | None]] = {
    "stream_route_counts": (stream_route_counts, None),
    "stream_top_routes": (stream_route_counts, top_routes_of_batch),
    "stream_profitable_areas": (stream_profitable_areas, None),
    "stream_profitable_areas_distinct": (partial(stream_profitable_areas, distinct_taxis=True), None),
    "stream_idle_alerts": (stream_idle_alerts, None),
    "stream_idle_alerts_sliding": (stream_idle_alerts_sliding, None),
    "stream_idle_compat": (stream_idle_compat, None),
    "stream_congestion_alerts": (stream_congestion_alerts, None),
    "stream_cell_rendezvous": (stream_cell_rendezvous, None),
    "stream_cell_rendezvous_compat": (stream_cell_rendezvous_compat, None),
    "stream_pleasant_drivers": (stream_driver_tips, pleasant_drivers_of_batch),
}

STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _stream(name, build, per_batch) for name, (build, per_batch) in BUILDERS.items()},
    "stream_top_routes_overall": _overall("stream_top_routes_overall", stream_route_counts, routes_order),
    "stream_pleasant_drivers_overall": _overall("stream_pleasant_drivers_overall", stream_driver_tips, drivers_order),
    "stream_reject_counts": stream_reject_counts,
}
