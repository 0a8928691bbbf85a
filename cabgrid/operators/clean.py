"""Cleaning and grid placement."""

from pyspark.sql import DataFrame, functions as F

from cabgrid.functions.grid import grid_cell, inside_grid


def clean_trips(trips: DataFrame) -> DataFrame:
    """Keep parsed, in-grid trips and add ``pickup_cell`` / ``dropoff_cell``.

    Drops parse rejects (when a ``reject_reason`` column is present), then
    every trip with an end outside the inclusive bounding box; zero
    coordinates, NaN and NULL all fall outside. The predicates are plain
    comparisons, so a parquet scan below receives them as pushed filters."""
    if "reject_reason" in trips.columns:
        trips = trips.where(F.col("reject_reason").isNull()).drop("reject_reason")
    kept = trips.where(inside_grid("pickup_long", "pickup_lat") & inside_grid("dropoff_long", "dropoff_lat"))
    return kept.withColumns(
        {
            "pickup_cell": grid_cell("pickup_long", "pickup_lat"),
            "dropoff_cell": grid_cell("dropoff_long", "dropoff_lat"),
        }
    )
