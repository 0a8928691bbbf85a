"""Profitable areas: recent fares of an area against the taxis that just
became free there.

``profitable_areas`` joins the 15-minute profit of a pickup cell with the
empty-taxi count of the same cell over the 30 minutes that end at the same
instant (a 30-minute window sliding by 15 minutes, so every profit window has
a partner). ``profitable_areas_compat`` reproduces the original scope instead:
inside one arrival slice, every dropoff window of a cell meets every pickup
window of that cell.
"""

from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.functions.money import avg_of_cents
from cabgrid.functions.rows import keyed_rows

PROFIT_WINDOW = "15 minutes"
EMPTY_WINDOW = "30 minutes"
EMPTY_SLIDE = "15 minutes"
COMPAT_SLICE = "1 hour"


def empty_taxis(
    trips: DataFrame,
    window: str = EMPTY_WINDOW,
    slide: str | None = EMPTY_SLIDE,
    distinct_taxis: bool = False,
) -> DataFrame:
    """Dropoffs per dropoff cell and (sliding) dropoff-time window, as
    ``num_empty_taxis``. ``distinct_taxis`` counts taxis instead of trips."""
    w = F.window("dropoff_dt", window, slide) if slide else F.window("dropoff_dt", window)
    n = F.count_distinct("medallion") if distinct_taxis else F.count(F.lit(1))
    return (
        trips.groupBy("dropoff_cell", w.alias("w"))
        .agg(n.alias("num_empty_taxis"))
        .select(
            "dropoff_cell",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "num_empty_taxis",
        )
    )


def area_profit(trips: DataFrame, window: str = PROFIT_WINDOW, cents: bool = False) -> DataFrame:
    """Mean of fare plus tip per pickup cell and pickup-time window. With ``cents``,
    amounts are whole cents and added up as such: the order of rows doesn't matter."""
    w = F.window("pickup_dt", window)
    paid = F.col("fare_amount") + F.col("tip_amount")
    return (
        trips.groupBy("pickup_cell", w.alias("w"))
        .agg((avg_of_cents(paid) if cents else F.avg(paid)).alias("area_profit"))
        .select(
            "pickup_cell",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "area_profit",
        )
    )


def _tagged_area_rows(trips: DataFrame, with_taxi: bool = False) -> DataFrame:
    """Every trip as three keyed rows: its pickup under (pickup cell, end of
    its 15-minute pickup window) carrying fare + tip, and its dropoff under
    (dropoff cell, end of each of the two sliding 30-minute windows that
    contain it) carrying a count of one."""
    step = F.expr(f"INTERVAL {EMPTY_SLIDE}")
    t = trips.withColumn("_p_end", F.window("pickup_dt", PROFIT_WINDOW).end)
    t = t.withColumn("_d_end", F.window("dropoff_dt", EMPTY_SLIDE).end)
    no_profit = F.lit(None).cast("double")
    names = ["cell", "window_end", "profit", "dropoffs"]
    rows = [
        [F.col("pickup_cell"), F.col("_p_end"), F.col("fare_amount") + F.col("tip_amount"), F.lit(0)],
        [F.col("dropoff_cell"), F.col("_d_end"), no_profit, F.lit(1)],
        [F.col("dropoff_cell"), F.col("_d_end") + step, no_profit, F.lit(1)],
    ]
    if with_taxi:  # only then is the taxi column read at all
        names.append("taxi")
        for r, taxi in zip(rows, [F.lit(None).cast("string"), F.col("medallion"), F.col("medallion")]):
            r.append(taxi)
    return t.select(keyed_rows(names, *rows))


def _empty_count(distinct_taxis: bool):
    """Empty taxis of a key: dropoffs (the original count), or distinct taxis
    that dropped off there."""
    return F.count_distinct("taxi") if distinct_taxis else F.sum("dropoffs")


def area_windows(trips: DataFrame, distinct_taxis: bool = False) -> DataFrame:
    """Per (cell, window end): ``area_profit`` (mean fare + tip of pickups in
    the 15 minutes ending there) and ``num_empty_taxis`` (dropoffs in the 30
    minutes ending there); only keys having both.

    This is the join of :func:`area_profit` and :func:`empty_taxis` on (cell,
    window end), computed as one grouped aggregation: both sides share the key,
    so one scan and one (map-side combined) shuffle replace two aggregations
    and a join."""
    return (
        _tagged_area_rows(trips, with_taxi=distinct_taxis)
        .groupBy("cell", "window_end")
        .agg(F.avg("profit").alias("area_profit"), _empty_count(distinct_taxis).alias("num_empty_taxis"))
        .where(F.col("area_profit").isNotNull() & (F.col("num_empty_taxis") > 0))
    )


def profitable_areas(trips: DataFrame, distinct_taxis: bool = False) -> DataFrame:
    """Profitability = area profit / empty taxis, per cell and window end,
    most profitable first. ``distinct_taxis`` counts each taxi once per
    window instead of every dropoff."""
    return area_windows(trips, distinct_taxis).select(
        "cell",
        "window_end",
        "area_profit",
        "num_empty_taxis",
        (F.col("area_profit") / F.col("num_empty_taxis")).alias("profitability"),
    ).orderBy(F.desc("profitability"), "cell", "window_end")


AREAS_VIEW = "cabgrid_area_rows"

PROFITABILITY_SQL = f"""
SELECT cell,
       window_end,
       avg(profit) AS area_profit,
       sum(dropoffs) AS num_empty_taxis,
       avg(profit) / sum(dropoffs) AS profitability
FROM {AREAS_VIEW}
GROUP BY cell, window_end
HAVING count(profit) > 0 AND sum(dropoffs) > 0
ORDER BY profitability DESC, cell, window_end
"""


def profitable_areas_sql(trips: DataFrame) -> DataFrame:
    """Same answer as :func:`profitable_areas`, written as SQL text over a
    temporary view of the keyed pickup / dropoff rows."""
    _tagged_area_rows(trips).createOrReplaceTempView(AREAS_VIEW)
    return trips.sparkSession.sql(PROFITABILITY_SQL)


def profitable_areas_compat(trips: DataFrame, slice_length: str = COMPAT_SLICE) -> DataFrame:
    """Original scope: trips are cut into arrival slices (pickup time,
    standing in for a micro-batch); within a slice the 30-minute tumbling
    dropoff counts of a cell meet every 15-minute pickup profit of that cell
    (the cell is the only join key).

    One scan feeds one tagged aggregation. The pickup windows of a (slice,
    cell) are then handed to its dropoff rows by a window ``collect_list``:
    pickups of a slice fall in at most slice / 15 minutes windows (4 for one
    hour), so the list is bounded by construction and the output is at most
    that many rows per dropoff window -- linear in the input."""
    t = trips.withColumn("slice_start", F.window("pickup_dt", slice_length).start)
    t = t.withColumn("_dw", F.window("dropoff_dt", EMPTY_WINDOW).start)
    t = t.withColumn("_pw", F.window("pickup_dt", PROFIT_WINDOW).start)
    rows = t.select(
        "slice_start",
        keyed_rows(
            ["is_pickup", "cell", "window_start", "profit"],
            [F.lit(False), F.col("dropoff_cell"), F.col("_dw"), F.lit(None).cast("double")],
            [F.lit(True), F.col("pickup_cell"), F.col("_pw"), F.col("fare_amount") + F.col("tip_amount")],
        ),
    )
    agg = rows.groupBy("slice_start", "cell", "is_pickup", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.avg("profit").alias("area_profit")
    )
    pickup_windows = F.collect_list(
        F.when(F.col("is_pickup"), F.struct(F.col("window_start").alias("pickup_window_start"), "area_profit"))
    ).over(Window.partitionBy("slice_start", "cell"))
    drops = agg.withColumn("pickups", pickup_windows).where(~F.col("is_pickup") & (F.col("n") > 0))
    pairs = drops.select(
        "slice_start",
        "cell",
        F.col("window_start").alias("dropoff_window_start"),
        F.col("n").alias("num_empty_taxis"),
        F.explode("pickups").alias("p"),
    )
    return pairs.select(
        "slice_start",
        "cell",
        "dropoff_window_start",
        F.col("p.pickup_window_start").alias("pickup_window_start"),
        F.col("p.area_profit").alias("area_profit"),
        "num_empty_taxis",
        (F.col("p.area_profit") / F.col("num_empty_taxis")).alias("profitability"),
    )
