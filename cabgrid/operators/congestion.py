"""Congested areas: a ride longer than the ones just before and after it,
followed by rides of strictly rising duration, within one taxi-day."""

from pyspark.sql import DataFrame, functions as F

from cabgrid.functions.text import congested_message
from cabgrid.operators.sequence import lag_name, lead_name, with_neighbors
from cabgrid.schema import NOT_CONGESTED_MESSAGE

DAY = "1 day"


def congestion_alerts(trips: DataFrame) -> DataFrame:
    """For every taxi-day, in pickup order, the first ride i with
    d[i] > d[i-1], d[i] > d[i+1] and d[i+1] < d[i+2] < d[i+3] (d = trip
    time); reports the pickup cell of ride i. A taxi-day is cut by hours, so
    no task holds more of it than one hour; picking the first match is a partial ``min_by``."""
    base = trips.select(
        "medallion",
        F.window("pickup_dt", DAY).start.alias("day"),
        "pickup_dt",
        "event_id",
        "trip_time",
        "pickup_cell",
    )
    n = with_neighbors(
        base,
        by=["medallion", "day"],
        order=["pickup_dt", "event_id"],
        values=["trip_time"],
        block=F.hour("pickup_dt"),
        lags=1,
        leads=3,
    )
    d = F.col("trip_time")
    before = F.col(lag_name("trip_time", 1))
    a1, a2, a3 = (F.col(lead_name("trip_time", j)) for j in (1, 2, 3))
    peak = (d > before) & (d > a1) & (a1 < a2) & (a2 < a3)
    first = (
        n.where(peak)
        .groupBy("medallion", "day")
        .agg(F.min_by("pickup_cell", F.struct("pickup_dt", "event_id")).alias("cell"))
    )
    return first.select("medallion", "day", "cell", congested_message("cell").alias("alert_message"))


def congestion_compat(trips: DataFrame) -> DataFrame:
    """Original behaviour: the pattern check stops at the first ride of every
    group, so each taxi-day yields the same negative message."""
    w = F.window("pickup_dt", DAY)
    return (
        trips.groupBy("medallion", w.alias("w"))
        .agg(F.count(F.lit(1)).alias("rides"))
        .select("medallion", F.col("w.start").alias("day"), F.lit(NOT_CONGESTED_MESSAGE).alias("alert_message"))
    )
