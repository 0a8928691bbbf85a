"""Streaming versions of the batch queries.

Every function takes a streaming trips DataFrame (see
:func:`cabgrid.streaming.read_trip_stream`) and returns a streaming
DataFrame in append mode: a row appears once its window is final (the
watermark passed the window end). Results carry TIMESTAMP_NTZ times like the
batch queries. Top-k views rank inside a micro-batch: every window closes in
exactly one batch, so ranking the rows of that batch ranks the whole window.

``delay`` is how late a trip may arrive, by its pickup time. Where a query's
windows are named by other times than the pickup, its watermark is widened by
the most that those times can be ahead of a pickup or behind it (window lengths,
and ``max_trip`` for a dropoff), so that no trip within the delay is late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cabgrid.functions.text import congested_message, idle_message
from cabgrid.operators.areas import EMPTY_WINDOW, _tagged_area_rows
from cabgrid.operators.idle import IDLE_WINDOW, duration_seconds, idle_compat
from cabgrid.operators.rendezvous import (
    RENDEZVOUS_WINDOW,
    next_pickups,
    rendezvous_events,
    rendezvous_firsts,
    rendezvous_pairs,
    rendezvous_rows,
)
from cabgrid.operators.routes import route_counts
from cabgrid.operators.tips import driver_tips
from cabgrid.operators.topk import top_k_per_group
from cabgrid.schema import IDLE_THRESHOLD_MINUTES, TOP_K
from cabgrid.sources.lines import OUTCOMES, outcome, parse_trips
from cabgrid.streaming.sink import OBSERVED
from cabgrid.streaming.source import to_wall_clock
from cabgrid.streaming.state import CONGESTION_OUTPUT, IDLE_OUTPUT, CongestedDays, IdleHours, IdlePanes, use_rocksdb

WATERMARK_DELAY = "3 hours"
#: The longest trip for which the delay holds in queries on dropoff times.
MAX_TRIP = "3 hours"
#: How far the sliding idle window moves on.
SLIDE = "5 minutes"


def widened(delay: str, *more: str) -> str:
    """A watermark delay of ``delay`` plus the given durations."""
    if duration_seconds(delay) <= 0:
        raise ValueError("the delay must be positive")
    return f"{duration_seconds(delay) + sum(duration_seconds(m) for m in more)} seconds"


def stream_route_counts(trips: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return to_wall_clock(route_counts(trips.withWatermark("pickup_dt", widened(delay))), ["window_start"])


def top_routes_of_batch(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    order = [F.desc("num_trips"), F.asc("pickup_cell"), F.asc("dropoff_cell")]
    return top_k_per_group(counts, ["window_start"], order, k)


def routes_order() -> list[Column]:
    """Best first, over all windows; a total order."""
    return [F.desc("num_trips"), F.asc("window_start"), F.asc("pickup_cell"), F.asc("dropoff_cell")]


def drivers_order() -> list[Column]:
    return [F.desc("total_tip_amount"), F.asc("day"), F.asc("medallion")]


def stream_profitable_areas(
    trips: DataFrame, delay: str = WATERMARK_DELAY, distinct_taxis: bool = False, max_trip: str = MAX_TRIP
) -> DataFrame:
    """One stateful aggregation keyed by (cell, window end), the watermark on
    the window end itself, which is at most ``max_trip`` and a window ahead of the
    pickup; no stream-stream join. ``distinct_taxis`` counts taxis exactly by two
    aggregations: one row of state for each taxi of a cell and window, and, when the
    window is over, the number of these rows."""
    rows = _tagged_area_rows(trips, with_taxi=distinct_taxis).withWatermark("window_end", widened(delay, max_trip, EMPTY_WINDOW))
    profit, paid, empty = F.sum("profit"), F.count("profit"), F.sum("dropoffs")
    if distinct_taxis:  # pickups name no taxi here
        rows = rows.groupBy("cell", "window_end", "taxi").agg(profit.alias("profit"), paid.alias("paid"))
        paid, empty = F.sum("paid"), F.count("taxi")
    agg = rows.groupBy("cell", "window_end").agg((profit / F.nullif(paid, F.lit(0))).alias("area_profit"), empty.alias("num_empty_taxis"))
    agg = agg.where(F.col("area_profit").isNotNull() & (F.col("num_empty_taxis") > 0))
    out = agg.select(
        "cell",
        "window_end",
        "area_profit",
        "num_empty_taxis",
        (F.col("area_profit") / F.col("num_empty_taxis")).alias("profitability"),
    )
    return to_wall_clock(out, ["window_end"])


def _taxi_panes(trips: DataFrame, delay: str, pane: str) -> DataFrame:
    """What a taxi did in each pane of time, when the pane is over: first pickup,
    last dropoff, seconds and number of the positive gaps inside it."""
    rows = trips.select("medallion", "pickup_dt", "event_id", "dropoff_dt").withWatermark("pickup_dt", widened(delay))
    panes = rows.groupBy("medallion", F.window("pickup_dt", pane).alias("w")).agg(
        F.sort_array(F.collect_list(F.struct("pickup_dt", "event_id", "dropoff_dt"))).alias("r")
    )
    following = F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0)))
    gaps = F.zip_with(following, F.slice("r", 1, F.size("r") - 1), lambda b, a: F.timestamp_diff("SECOND", a["dropoff_dt"], b["pickup_dt"]))
    panes = panes.select(
        "medallion",
        F.col("w.start").alias("window_start"),
        # As numbers: a time out of a watermarked column is watched too, and a pane
        # that begins before the watermark and ends after it would count as late.
        F.unix_micros(F.get("r", F.lit(0))["pickup_dt"]).alias("first_pickup"),
        F.unix_micros(F.element_at("r", -1)["dropoff_dt"]).alias("last_dropoff"),
        F.filter(gaps, lambda g: g > 0).alias("gaps"),
    )
    total = F.aggregate("gaps", F.lit(0).cast("long"), lambda a, g: a + g)
    return panes.select(
        "medallion", "window_start", "first_pickup", "last_dropoff", total.alias("gap_seconds"), F.size("gaps").cast("long").alias("gaps")
    )


def stream_idle_alerts(
    trips: DataFrame,
    delay: str = WATERMARK_DELAY,
    window: str = IDLE_WINDOW,
    threshold: float = IDLE_THRESHOLD_MINUTES,
    forget_after: str | None = None,
) -> DataFrame:
    """A taxi's rows of a window are gathered until it closes; the gap to the window
    before needs the taxi's last dropoff (:mod:`cabgrid.streaming.state`), which is
    kept until its next trip, however late that is; with ``forget_after`` it is
    dropped that long after (a longer gap is then not reported)."""
    use_rocksdb(trips.sparkSession)
    hours = _taxi_panes(trips, delay, window)
    forget_us = duration_seconds(forget_after) * 1_000_000 if forget_after else None
    alerts = hours.groupBy("medallion").transformWithStateInPandas(
        IdleHours(float(threshold), forget_us), IDLE_OUTPUT, "append", "eventTime" if forget_after else "none"
    )
    return to_wall_clock(alerts, ["window_start"]).withColumn("alert_message", idle_message("avg_idle_minutes"))


def stream_idle_alerts_sliding(
    trips: DataFrame,
    delay: str = WATERMARK_DELAY,
    window: str = IDLE_WINDOW,
    slide: str = SLIDE,
    threshold: float = IDLE_THRESHOLD_MINUTES,
) -> DataFrame:
    """The retained hour, moved on by ``slide``: rows are gathered by pane of that
    length, and a taxi's last panes are kept as a ring of sums to which the newest is
    added and from which the expired one is subtracted (:mod:`cabgrid.streaming.state`).
    No row is held, or counted, once for each window that it lies in."""
    length, step = duration_seconds(window), duration_seconds(slide)
    if step <= 0 or length % step:
        raise ValueError("a window must be a whole number of slides")
    use_rocksdb(trips.sparkSession)
    alerts = _taxi_panes(trips, delay, slide).groupBy("medallion").transformWithStateInPandas(
        IdlePanes(float(threshold), step * 1_000_000, length // step), IDLE_OUTPUT, "append", "eventTime"
    )
    return to_wall_clock(alerts, ["window_start"]).withColumn("alert_message", idle_message("avg_idle_minutes"))


def stream_idle_compat(
    trips: DataFrame, delay: str = WATERMARK_DELAY, window: str = IDLE_WINDOW, threshold: float = IDLE_THRESHOLD_MINUTES
) -> DataFrame:
    """The original arithmetic; a trip needs no other trip, so it is one windowed mean."""
    return to_wall_clock(idle_compat(trips.withWatermark("pickup_dt", widened(delay)), window, threshold), ["window_start"])


def stream_congestion_alerts(trips: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """A taxi's rides of an hour are gathered until it closes; what an hour hands to
    the next of its day is in :mod:`cabgrid.streaming.state`."""
    use_rocksdb(trips.sparkSession)
    rows = trips.select("medallion", "pickup_dt", "event_id", "trip_time", "pickup_cell").withWatermark("pickup_dt", widened(delay))
    hours = rows.groupBy("medallion", F.window("pickup_dt", "1 hour").alias("w")).agg(
        F.sort_array(F.collect_list(F.struct("pickup_dt", "event_id", "trip_time", "pickup_cell"))).alias("r")
    )
    hours = hours.select(
        "medallion", F.col("w.start").alias("window_start"), F.col("r.trip_time").alias("durations"), F.col("r.pickup_cell").alias("cells")
    )
    alerts = hours.groupBy("medallion").transformWithStateInPandas(CongestedDays(), CONGESTION_OUTPUT, "append", "eventTime")
    return to_wall_clock(alerts, ["day"]).withColumn("alert_message", congested_message("cell"))


def stream_cell_rendezvous(
    trips: DataFrame, delay: str = WATERMARK_DELAY, window: str = RENDEZVOUS_WINDOW, max_trip: str = MAX_TRIP
) -> DataFrame:
    """The watermark is on the window start that names a group: at most ``max_trip``
    ahead of the pickup, and at most two windows behind it."""
    rows = rendezvous_events(trips, window).withWatermark("bucket", widened(delay, max_trip, window, window))
    return to_wall_clock(next_pickups(rows, window), ["ddt", "pdt"])


def stream_cell_rendezvous_compat(
    trips: DataFrame, delay: str = WATERMARK_DELAY, window: str = RENDEZVOUS_WINDOW, max_trip: str = MAX_TRIP
) -> DataFrame:
    rows = rendezvous_rows(trips, window).withWatermark("bucket", widened(delay, max_trip, window, window))
    return to_wall_clock(rendezvous_pairs(rendezvous_firsts(rows), window), ["ddt", "pdt"])


def stream_driver_tips(trips: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return to_wall_clock(driver_tips(trips.withWatermark("pickup_dt", widened(delay))), ["day"])


def pleasant_drivers_of_batch(tips: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k_per_group(tips, ["day"], [F.desc("total_tip_amount"), F.asc("medallion")], k)


def stream_outcomes(lines: DataFrame, id_col: str | None = None) -> DataFrame:
    """Trip lines with what became of each: the columns of a trip, ``outcome`` and,
    for a line that is no clean trip, ``line`` itself. The numbers of lines by outcome are observed on the
    way, see :func:`cabgrid.streaming.sink.observed_outcomes`. Written by
    ``write_stream(..., partition_by=["outcome"])``, trips and dead letters leave a
    micro-batch in one job, each under its outcome's folder."""
    done = parse_trips(lines, id_col=id_col, keep_line=True).withColumn("outcome", outcome())
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    done = done.observe(OBSERVED, *counts).withColumn("line", F.when(F.col("outcome") != "accepted", F.col("line")))
    return done.drop("reject_reason")
