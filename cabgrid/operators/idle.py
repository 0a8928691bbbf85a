"""Idle taxis: time between a taxi's dropoff and its next pickup.

``idle_alerts`` measures the gap before every trip (its pickup minus the
previous trip's dropoff of the same taxi), averages the positive gaps per
taxi and hour, and alerts above a threshold. ``idle_compat`` keeps the
original arithmetic instead: pickup minus dropoff of the *same* trip, taken
modulo one day, minutes field only.
"""

from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.functions.text import idle_message
from cabgrid.functions.timecols import seconds_between, wrapped_minutes
from cabgrid.operators.sequence import lag_name, with_neighbors
from cabgrid.schema import IDLE_THRESHOLD_MINUTES

IDLE_WINDOW = "1 hour"


def idle_gaps(trips: DataFrame) -> DataFrame:
    """One row per trip that has an earlier trip of the same taxi:
    ``prev_dropoff_dt`` and ``gap_seconds`` (may be zero or negative when
    trips overlap). A taxi's history is cut by days, so a very busy taxi is
    spread over many tasks."""
    base = trips.select("medallion", "pickup_dt", "event_id", "dropoff_dt")
    n = with_neighbors(
        base, by=["medallion"], order=["pickup_dt", "event_id"], values=["dropoff_dt"], block=F.to_date("pickup_dt"), lags=1
    )
    prev = F.col(lag_name("dropoff_dt", 1))
    return n.where(prev.isNotNull()).select(
        "medallion",
        "event_id",
        "pickup_dt",
        prev.alias("prev_dropoff_dt"),
        seconds_between(prev, F.col("pickup_dt")).cast("int").alias("gap_seconds"),
    )


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(duration: str) -> int:
    """Seconds of a duration such as ``"1 hour 30 minutes"``."""
    parts = duration.lower().split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        if unit.rstrip("s") not in _UNIT_SECONDS:
            raise ValueError(f"not a duration: {duration!r}")
        total += int(n) * _UNIT_SECONDS[unit.rstrip("s")]
    return total


def _window_means(rows: DataFrame, value_col: str, window: str, slide: str | None) -> DataFrame:
    """Mean of ``value_col`` per taxi and pickup window that has rows, as
    ``avg_value``; windows start at multiples of ``slide`` (default: ``window``),
    of which a window is a whole number.

    For sliding windows the rows are summed once per taxi and pane (a slide long).
    A window is named by its last pane; every pane names the windows from itself up
    to the next pane with rows, as long as they reach back to it. A range frame
    over those names then adds up the panes of each window."""
    length = duration_seconds(window)
    step = duration_seconds(slide) if slide else length
    if step <= 0 or length % step:
        raise ValueError("a window must be a whole number of slides")
    value = F.col(value_col).cast("double")
    if step == length:
        means = rows.groupBy("medallion", F.window("pickup_dt", window).alias("w")).agg((F.sum(value) / F.count(F.lit(1))).alias("avg_value"))
        return means.select("medallion", F.col("w.start").alias("window_start"), "avg_value")
    panes_per_window = length // step
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = F.floor(F.timestamp_diff("SECOND", epoch, F.col("pickup_dt")) / F.lit(step))
    panes = rows.groupBy("medallion", number.alias("pane")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    by_pane = Window.partitionBy("medallion").orderBy("pane")
    reach = F.col("pane") + F.lit(panes_per_window - 1)
    until = F.least(F.coalesce(F.lead("pane").over(by_pane) - 1, reach), reach)
    named = panes.withColumn("until", until).select("medallion", "pane", "total", "n", F.explode(F.sequence("pane", "until")).alias("last"))
    own = F.col("last") == F.col("pane")
    frame = Window.partitionBy("medallion").orderBy("last").rangeBetween(-(panes_per_window - 1), 0)
    total, n = (F.sum(F.when(own, F.col(c))).over(frame) for c in ("total", "n"))
    start = F.timestamp_add("SECOND", (F.col("last") - F.lit(panes_per_window - 1)) * F.lit(step), epoch)
    return named.select("medallion", start.alias("window_start"), (total / n).alias("avg_value"))


def idle_alerts(
    trips: DataFrame,
    window: str = IDLE_WINDOW,
    threshold: float = IDLE_THRESHOLD_MINUTES,
    slide: str | None = None,
) -> DataFrame:
    """Taxis whose mean positive idle gap, over the trips picked up in a
    window (tumbling, or sliding by ``slide``), exceeds ``threshold``
    minutes."""
    g = idle_gaps(trips).where(F.col("gap_seconds") > 0)
    a = _window_means(g, "gap_seconds", window, slide)
    minutes = (F.col("avg_value") / F.lit(60.0)).alias("avg_idle_minutes")
    return (
        a.select("medallion", "window_start", minutes)
        .where(F.col("avg_idle_minutes") > F.lit(float(threshold)))
        .withColumn("alert_message", idle_message("avg_idle_minutes"))
    )


#: The slide of the original's retained hour.
ORIGINAL_SLIDE = "5 seconds"


def idle_alert_stretches(
    trips: DataFrame,
    window: str = IDLE_WINDOW,
    threshold: float = IDLE_THRESHOLD_MINUTES,
    slide: str = ORIGINAL_SLIDE,
) -> DataFrame:
    """:func:`idle_alerts` over windows sliding by ``slide``, as the longest
    stretches of consecutive windows with one mean: ``first_window`` and
    ``last_window`` (their starts), ``avg_idle_minutes``.

    A sweep: a gap is added when the window's end reaches its pickup and taken off a
    window later, so the sums by step are running sums of what is added and taken off;
    the work grows with the trips, not with the windows. The sweep runs in spans of a
    taxi's time (a gap that reaches into the next span is in both), so that a busy
    taxi is many groups; stretches that meet at the edge of a span are joined after."""
    length, step = duration_seconds(window), duration_seconds(slide)
    if step <= 0 or length % step:
        raise ValueError("a window must be a whole number of slides")
    steps = length // step
    span = max(steps, duration_seconds("1 day") // step)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    g = idle_gaps(trips).where(F.col("gap_seconds") > 0)
    # Windows are numbered by their last step: a gap is in those from its own step on.
    own = F.floor(F.timestamp_diff("SECOND", epoch, F.col("pickup_dt")) / F.lit(step)).cast("long")
    g = g.groupBy("medallion", own.alias("at")).agg(F.sum(F.col("gap_seconds").cast("long")).alias("total"), F.count(F.lit(1)).alias("n"))
    first_span = F.floor(F.col("at") / F.lit(span)).cast("long")
    last_span = F.floor((F.col("at") + F.lit(steps - 1)) / F.lit(span)).cast("long")
    g = g.select("*", F.explode(F.sequence(first_span, last_span)).alias("span"))
    begin, end = F.col("span") * span, (F.col("span") + 1) * span
    change = lambda at, sign: F.struct(at.alias("at"), (F.col("total") * sign).alias("total"), (F.col("n") * sign).alias("n"))
    both = F.array(change(F.greatest("at", begin), 1), change(F.least(F.col("at") + steps, end), -1))
    changes = g.select("medallion", "span", F.inline(both)).groupBy("medallion", "span", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    in_span = Window.partitionBy("medallion", "span").orderBy("at")
    so_far = in_span.rowsBetween(Window.unboundedPreceding, 0)
    level = changes.select(
        "medallion", "span", "at", (F.lead("at").over(in_span) - 1).alias("until"), F.sum("total").over(so_far).alias("total"), F.sum("n").over(so_far).alias("n")
    ).where("n > 0")
    minutes = F.col("total").cast("double") / F.col("n") / F.lit(60.0)
    level = level.select("medallion", "span", "at", "until", minutes.alias("avg_idle_minutes")).where(F.col("avg_idle_minutes") > F.lit(float(threshold)))
    inside = _joined(level, ["medallion", "span"])
    at_edge = (F.col("at") == begin) | (F.col("until") == end - 1)
    crossing = _joined(inside.where(at_edge), ["medallion"])
    whole = inside.where(~at_edge).select("medallion", "at", "until", "avg_idle_minutes").unionByName(crossing)
    start = lambda c: F.timestamp_add("SECOND", (F.col(c) - F.lit(steps - 1)) * F.lit(step), epoch)
    return whole.select("medallion", start("at").alias("first_window"), start("until").alias("last_window"), "avg_idle_minutes")


def _joined(stretches: DataFrame, by: list[str]) -> DataFrame:
    """Stretches of a group that follow one another with the same mean, as one."""
    order = Window.partitionBy(*by).orderBy("at")
    goes_on = (F.lag("until").over(order) == F.col("at") - 1) & (F.lag("avg_idle_minutes").over(order) == F.col("avg_idle_minutes"))
    marked = stretches.withColumn("new", F.when(goes_on, 0).otherwise(1))
    marked = marked.withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "stretch").agg(
        F.min("at").alias("at"), F.max("until").alias("until"), F.first("avg_idle_minutes").alias("avg_idle_minutes")
    ).drop("stretch")


def idle_compat(
    trips: DataFrame,
    window: str = IDLE_WINDOW,
    threshold: float = IDLE_THRESHOLD_MINUTES,
    slide: str | None = None,
) -> DataFrame:
    """Original arithmetic: per trip, minutes field of (pickup - dropoff)
    modulo one day; positive values averaged per taxi and window (the window
    stands in for the retained hour of micro-batches)."""
    minutes = wrapped_minutes(seconds_between("dropoff_dt", "pickup_dt"))
    rows = trips.select("medallion", "pickup_dt", minutes.alias("idle_minutes")).where(
        F.col("idle_minutes") > 0
    )
    a = _window_means(rows, "idle_minutes", window, slide)
    return (
        a.select("medallion", "window_start", F.col("avg_value").alias("avg_idle_minutes"))
        .where(F.col("avg_idle_minutes") > F.lit(float(threshold)))
        .withColumn("alert_message", idle_message("avg_idle_minutes"))
    )
