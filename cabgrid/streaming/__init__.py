"""Structured Streaming: sources, sinks and the streaming queries."""

from cabgrid.streaming.source import read_trip_stream, read_trip_stream_kafka, to_event_time, to_wall_clock, trips_of_messages
from cabgrid.streaming.sink import BatchBanner, best_so_far, observed_outcomes, read_best, write_stream
from cabgrid.streaming.queries import (
    MAX_TRIP,
    WATERMARK_DELAY,
    stream_route_counts,
    top_routes_of_batch,
    stream_profitable_areas,
    stream_idle_alerts,
    stream_idle_alerts_sliding,
    stream_idle_compat,
    stream_congestion_alerts,
    stream_cell_rendezvous,
    stream_cell_rendezvous_compat,
    stream_driver_tips,
    stream_outcomes,
    pleasant_drivers_of_batch,
    routes_order,
    drivers_order,
)

__all__ = [
    "read_trip_stream",
    "read_trip_stream_kafka",
    "trips_of_messages",
    "to_event_time",
    "to_wall_clock",
    "write_stream",
    "BatchBanner",
    "best_so_far",
    "read_best",
    "observed_outcomes",
    "stream_outcomes",
    "stream_idle_alerts_sliding",
    "routes_order",
    "drivers_order",
    "WATERMARK_DELAY",
    "MAX_TRIP",
    "stream_route_counts",
    "top_routes_of_batch",
    "stream_profitable_areas",
    "stream_idle_alerts",
    "stream_idle_compat",
    "stream_congestion_alerts",
    "stream_cell_rendezvous",
    "stream_cell_rendezvous_compat",
    "stream_driver_tips",
    "pleasant_drivers_of_batch",
]
