"""Frequent routes: trips per (pickup cell, dropoff cell) and half hour."""

from pyspark.sql import DataFrame, functions as F

from cabgrid.operators.topk import top_k, top_k_per_group
from cabgrid.schema import TOP_K

ROUTE_WINDOW = "30 minutes"


def route_counts(trips: DataFrame, window: str = ROUTE_WINDOW) -> DataFrame:
    """``num_trips`` per route and tumbling pickup-time window. Counting is
    partial per task before the shuffle, so a hot route costs one row per
    task, not one per trip."""
    w = F.window("pickup_dt", window)
    return (
        trips.groupBy("pickup_cell", "dropoff_cell", w.alias("w"))
        .agg(F.count("fare_amount").alias("num_trips"))
        .select("pickup_cell", "dropoff_cell", F.col("w.start").alias("window_start"), "num_trips")
    )


def _route_order():
    return [F.desc("num_trips"), F.asc("window_start"), F.asc("pickup_cell"), F.asc("dropoff_cell")]


def top_routes(trips: DataFrame, k: int = TOP_K, window: str = ROUTE_WINDOW) -> DataFrame:
    """The k most frequent (route, window) pairs over the whole input."""
    return top_k(route_counts(trips, window), _route_order(), k)


def top_routes_per_window(trips: DataFrame, k: int = TOP_K, window: str = ROUTE_WINDOW) -> DataFrame:
    """The k most frequent routes of every window, ranked 1..k."""
    order = [F.desc("num_trips"), F.asc("pickup_cell"), F.asc("dropoff_cell")]
    return top_k_per_group(route_counts(trips, window), ["window_start"], order, k)
