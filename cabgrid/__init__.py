"""cabgrid: taxi-trip analytics on Spark DataFrames and Structured Streaming.

Trips are parsed from text lines (or derived from a table), cleaned, placed on
a 500 m grid, and answered by a handful of declarative queries: frequent
routes, profitable areas, idle taxis, congested areas and generous riders.
Every batch query takes a trips DataFrame and returns a DataFrame; the
streaming variants in :mod:`cabgrid.streaming` run the same logic
incrementally with watermarks.
"""

from cabgrid.schema import TRIP_SCHEMA, TRIP_COLUMNS
from cabgrid.sources import (
    trips_from_events,
    trip_lines,
    parse_trips,
    read_trips,
    reject_counts,
    read_trip_table,
    write_trip_table,
)
from cabgrid.functions import grid_cell
from cabgrid.operators import (
    clean_trips,
    with_neighbors,
    area_windows,
    route_counts,
    top_routes,
    top_routes_per_window,
    empty_taxis,
    area_profit,
    profitable_areas,
    profitable_areas_sql,
    profitable_areas_compat,
    idle_gaps,
    idle_alerts,
    idle_alert_stretches,
    idle_compat,
    cell_rendezvous,
    cell_rendezvous_compat,
    congestion_alerts,
    congestion_compat,
    driver_tips,
    pleasant_drivers,
    pleasant_drivers_per_day,
)

__all__ = [
    "TRIP_SCHEMA",
    "TRIP_COLUMNS",
    "trips_from_events",
    "trip_lines",
    "parse_trips",
    "read_trips",
    "reject_counts",
    "read_trip_table",
    "write_trip_table",
    "grid_cell",
    "clean_trips",
    "with_neighbors",
    "area_windows",
    "route_counts",
    "top_routes",
    "top_routes_per_window",
    "empty_taxis",
    "area_profit",
    "profitable_areas",
    "profitable_areas_sql",
    "profitable_areas_compat",
    "idle_gaps",
    "idle_alerts",
    "idle_alert_stretches",
    "idle_compat",
    "cell_rendezvous",
    "cell_rendezvous_compat",
    "congestion_alerts",
    "congestion_compat",
    "driver_tips",
    "pleasant_drivers",
    "pleasant_drivers_per_day",
]
