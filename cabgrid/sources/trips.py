"""A deterministic trip table derived from the ``events`` table, and its text
form (the comma-separated line layout the parser reads).

Every money and coordinate value is built from exact binary fractions or
fixed literals, so sums and averages do not depend on summation order and
any engine computing the same formulas gets bit-equal doubles.
"""

from pyspark.sql import DataFrame, functions as F

from cabgrid.functions.timecols import trunc_to_second
from cabgrid.schema import (
    CELL_STEP_LAT,
    CELL_STEP_LON,
    LINE_FIELDS,
    LINE_MIN_FIELDS,
    LINE_TIMESTAMP_FORMAT,
    ORIGIN_LAT,
    ORIGIN_LON,
    TRIP_COLUMNS,
)

# Fixed values of the derivation (shared with the SQL oracle).
ZERO_COORD_RESIDUE = 7  # event_id % 50 == 7 -> both pickup coordinates 0
OUTSIDE_RESIDUE = 13  # event_id % 50 == 13 -> dropoff far west of the grid


def trips_from_events(events: DataFrame) -> DataFrame:
    """One trip per event: taxi from the user id, pickup at the event time,
    a duration of 5 to 45 minutes, pickup and dropoff near the grid origin,
    fare from the event value and tip from the id. Rows with
    ``event_id % 50 == 7`` get zero coordinates and rows with
    ``event_id % 50 == 13`` an out-of-grid dropoff, so cleaning has work."""
    eid = F.col("event_id")
    pickup = trunc_to_second(F.col("ts"))
    trip_time = (F.lit(300) + (eid * 7919) % 2400).cast("int")
    zero = (eid % 50) == ZERO_COORD_RESIDUE
    outside = (eid % 50) == OUTSIDE_RESIDUE
    pickup_long = F.when(zero, F.lit(0.0)).otherwise(
        F.lit(ORIGIN_LON) + (F.lit(100) + (eid * 31) % 3) * F.lit(CELL_STEP_LON) + F.lit(1e-3)
    )
    pickup_lat = F.when(zero, F.lit(0.0)).otherwise(
        F.lit(ORIGIN_LAT) - (F.lit(150) + (eid * 17) % 2) * F.lit(CELL_STEP_LAT) - F.lit(1e-3)
    )
    dropoff_long = F.when(outside, F.lit(-80.0)).otherwise(
        F.lit(ORIGIN_LON) + (F.lit(100) + (eid * 13) % 3) * F.lit(CELL_STEP_LON) - F.lit(1e-3)
    )
    dropoff_lat = F.lit(ORIGIN_LAT) - (F.lit(150) + (eid * 7) % 2) * F.lit(CELL_STEP_LAT) + F.lit(1e-3)
    fare = F.floor(F.col("value") * F.lit(4.0)) / F.lit(4.0) + F.lit(2.5)
    tip = (eid % 11) * F.lit(0.25)
    base = events.select(
        eid.alias("event_id"),
        F.concat(F.lit("M"), F.floor(F.col("user_id") / F.lit(5.0)).cast("bigint").cast("string")).alias(
            "medallion"
        ),
        pickup.alias("pickup_dt"),
        trip_time.alias("trip_time"),
        ((eid % 37) * F.lit(0.5)).alias("trip_distance"),
        pickup_long.alias("pickup_long"),
        pickup_lat.alias("pickup_lat"),
        dropoff_long.alias("dropoff_long"),
        dropoff_lat.alias("dropoff_lat"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
    )
    return base.select(
        *[
            (F.col("pickup_dt") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("trip_time"))).alias(
                "dropoff_dt"
            )
            if c == "dropoff_dt"
            else (F.col("fare_amount") + F.col("tip_amount")).alias("total_amount")
            if c == "total_amount"
            else F.col(c)
            for c in TRIP_COLUMNS
        ]
    )


def trip_lines(trips: DataFrame, filler: str = "x") -> DataFrame:
    """Render trips as comma-separated lines (``event_id``, ``value``).
    Unread positions hold ``filler``; timestamps use the line format."""
    by_pos = {pos: name for name, pos in LINE_FIELDS.items()}
    parts = []
    for pos in range(LINE_MIN_FIELDS):
        name = by_pos.get(pos)
        if name is None:
            parts.append(F.lit(filler))
        elif name in ("pickup_dt", "dropoff_dt"):
            parts.append(F.date_format(F.col(name), LINE_TIMESTAMP_FORMAT))
        else:
            parts.append(F.col(name).cast("string"))
    return trips.select("event_id", F.concat_ws(",", *parts).alias("value"))
