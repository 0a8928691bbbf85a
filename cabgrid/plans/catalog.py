"""Every batch query as a callable ``(spark, table_dir) -> DataFrame``.

Each one reads the ``events`` table of ``table_dir``, derives the trip table
from it (:func:`cabgrid.sources.trips_from_events`) and runs one operator over
all of it. Nothing is collected; the plans are lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabgrid import operators as ops
from cabgrid.sources import load_table, parse_trips, reject_counts, trip_lines, trips_from_events


def raw_trip_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """Trips derived from ``events`` before cleaning."""
    events = load_table(spark, table_dir, "events").select("event_id", "ts", "user_id", "value")
    return trips_from_events(events)


def derived_trips(spark: SparkSession, table_dir: str) -> DataFrame:
    """Cleaned trips with grid cells."""
    return ops.clean_trips(raw_trip_table(spark, table_dir))


def derived_lines(spark: SparkSession, table_dir: str) -> DataFrame:
    """The derived trips as text lines, some of them spoilt."""
    return spoilt_lines(raw_trip_table(spark, table_dir))


def spoilt_lines(trips: DataFrame) -> DataFrame:
    """Trips as text lines, some of them spoilt by their id: with
    ``event_id % 50`` 21 empty, 22 too short, 23 with a trip time that is no number
    and 24 with a pickup time in another format."""
    lines = trip_lines(trips)
    kind = F.col("event_id") % 50
    value = F.col("value")
    spoilt = (
        F.when(kind == 21, F.lit(""))
        .when(kind == 22, F.lit("a,b,c"))
        .when(kind == 23, F.regexp_replace(value, r"^((?:[^,]*,){4})[^,]*", "$1x"))
        .when(kind == 24, F.regexp_replace(value, r"^((?:[^,]*,){2}[^, ]*) ", "$1T"))
    )
    return lines.withColumn("value", F.coalesce(spoilt, value))


def _parsed(spark: SparkSession, table_dir: str) -> DataFrame:
    return parse_trips(derived_lines(spark, table_dir), id_col="event_id")


def cent_trips(spark: SparkSession, table_dir: str) -> DataFrame:
    """Cleaned trips whose fares and tips are any number of cents."""
    eid = F.col("event_id")
    cents = {"fare_amount": (eid * 53) % 89, "tip_amount": (eid * 31) % 97}
    return derived_trips(spark, table_dir).withColumns({c: F.col(c) + n * F.lit(0.01) for c, n in cents.items()})


def _on_trips(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, table_dir: str) -> DataFrame:
        return fn(derived_trips(spark, table_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# Queries over a cleaned trips DataFrame, usable on any trip source.
TRIP_OPERATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "route_counts": ops.route_counts,
    "top_routes": ops.top_routes,
    "top_routes_per_window": ops.top_routes_per_window,
    "empty_taxis": ops.empty_taxis,
    "area_profit": ops.area_profit,
    "profitable_areas": ops.profitable_areas,
    "profitable_areas_sql": ops.profitable_areas_sql,
    "profitable_areas_compat": ops.profitable_areas_compat,
    "idle_gaps": ops.idle_gaps,
    "idle_alerts": ops.idle_alerts,
    "idle_alert_stretches": ops.idle_alert_stretches,
    "idle_compat": ops.idle_compat,
    "cell_rendezvous": ops.cell_rendezvous,
    "cell_rendezvous_compat": ops.cell_rendezvous_compat,
    "congestion_alerts": ops.congestion_alerts,
    "congestion_compat": ops.congestion_compat,
    "driver_tips": ops.driver_tips,
    "pleasant_drivers": ops.pleasant_drivers,
    "pleasant_drivers_per_day": ops.pleasant_drivers_per_day,
    "area_profit_cents": partial(ops.area_profit, cents=True),
    "pleasant_drivers_cents": partial(ops.pleasant_drivers, cents=True),
    "top_routes_sql": ops.top_routes_sql,
    "idle_compat_sql": ops.idle_compat_sql,
    "pleasant_drivers_sql": ops.pleasant_drivers_sql,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_trips": _parsed,
    "reject_counts": lambda spark, d: reject_counts(_parsed(spark, d)),
    "clean_trips": derived_trips,
    "route_counts": _on_trips(ops.route_counts),
    "top_routes": _on_trips(ops.top_routes),
    "top_routes_per_window": _on_trips(ops.top_routes_per_window),
    "empty_taxis": _on_trips(ops.empty_taxis),
    "area_profit": _on_trips(ops.area_profit),
    "profitable_areas": _on_trips(ops.profitable_areas),
    "profitable_areas_sql": _on_trips(ops.profitable_areas_sql),
    "profitable_areas_compat": _on_trips(ops.profitable_areas_compat),
    "profitable_areas_distinct": lambda spark, d: ops.profitable_areas(derived_trips(spark, d), distinct_taxis=True),
    "idle_gaps": _on_trips(ops.idle_gaps),
    "idle_alerts": _on_trips(ops.idle_alerts),
    "idle_alerts_sliding": lambda spark, d: ops.idle_alerts(derived_trips(spark, d), slide="5 minutes"),
    "idle_alert_stretches": _on_trips(ops.idle_alert_stretches),
    "idle_compat": _on_trips(ops.idle_compat),
    "cell_rendezvous": _on_trips(ops.cell_rendezvous),
    "cell_rendezvous_compat": _on_trips(ops.cell_rendezvous_compat),
    "congestion_alerts": _on_trips(ops.congestion_alerts),
    "congestion_compat": _on_trips(ops.congestion_compat),
    "driver_tips": _on_trips(ops.driver_tips),
    "pleasant_drivers": _on_trips(ops.pleasant_drivers),
    "pleasant_drivers_per_day": _on_trips(ops.pleasant_drivers_per_day),
    "area_profit_cents": lambda spark, d: ops.area_profit(cent_trips(spark, d), cents=True),
    "pleasant_drivers_cents": lambda spark, d: ops.pleasant_drivers(cent_trips(spark, d), cents=True),
    "top_routes_sql": lambda spark, d: ops.top_routes_sql(raw_trip_table(spark, d)),
    "idle_compat_sql": lambda spark, d: ops.idle_compat_sql(raw_trip_table(spark, d)),
    "pleasant_drivers_sql": lambda spark, d: ops.pleasant_drivers_sql(raw_trip_table(spark, d)),
}
