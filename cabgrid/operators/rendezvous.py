"""A taxi that drops off in a cell and picks up again in the same cell soon
after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.functions.rows import keyed_rows

RENDEZVOUS_WINDOW = "1 hour"


def cell_rendezvous(trips: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    """Every dropoff (``event_id``, ``ddt``) with the taxi's next pickup in the
    same cell (``pdt``), at or after it and at most ``window`` later.

    A pickup at most one window length after a dropoff lies in the dropoff's window
    or the next one, so each pickup is keyed under its own window and under the one
    before; one shuffle by (taxi, cell, window) brings each dropoff together with
    all its candidates. A group holds what one taxi does in one cell in two
    windows. It is read backwards in time with the smallest pickup so far, so its rows
    are sorted (and spilled, if they are many) but never gathered in one row."""
    backwards = [F.coalesce("ddt", "pdt").desc(), F.col("ddt").asc_nulls_first()]  # a pickup before a dropoff of its instant
    group = Window.partitionBy("medallion", "cell", "bucket").orderBy(*backwards)
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rendezvous_events(trips, window).withColumn("pdt", F.min("pdt").over(so_far))
    met = met.where(F.col("ddt").isNotNull() & (F.col("pdt") <= F.col("ddt") + F.expr(f"INTERVAL {window}")))
    return met.select("medallion", "cell", "event_id", "ddt", "pdt")


def rendezvous_events(trips: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    """Each trip as three keyed rows (taxi, cell, window start): its dropoff, its
    pickup, and its pickup once more under the window before."""
    length = F.expr(f"INTERVAL {window}")
    t = trips.withColumn("_dw", F.window("dropoff_dt", window).start)
    t = t.withColumn("_pw", F.window("pickup_dt", window).start)
    no_ts = F.lit(None).cast(trips.schema["pickup_dt"].dataType)
    no_id = F.lit(None).cast("long")
    return t.select(
        "medallion",
        keyed_rows(
            ["cell", "bucket", "event_id", "ddt", "pdt"],
            [F.col("dropoff_cell"), F.col("_dw"), F.col("event_id"), F.col("dropoff_dt"), no_ts],
            [F.col("pickup_cell"), F.col("_pw"), no_id, no_ts, F.col("pickup_dt")],
            [F.col("pickup_cell"), F.col("_pw") - length, no_id, no_ts, F.col("pickup_dt")],
        ),
    )


def next_pickups(events: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    """The same by one aggregation, as a stream needs it (it has no ordered windows):
    what a taxi does in a cell in two windows is gathered in a row."""
    length = F.expr(f"INTERVAL {window}")
    groups = events.groupBy("medallion", "cell", "bucket").agg(
        F.collect_list(F.when(F.col("ddt").isNotNull(), F.struct("event_id", "ddt"))).alias("drops"), F.collect_list("pdt").alias("picks")
    )
    each = groups.where((F.size("drops") > 0) & (F.size("picks") > 0)).select("medallion", "cell", "picks", F.explode("drops").alias("d"))
    following = F.array_min(F.filter("picks", lambda p: p >= F.col("d.ddt")))
    met = each.select("medallion", "cell", F.col("d.event_id").alias("event_id"), F.col("d.ddt").alias("ddt"), following.alias("pdt"))
    return met.where(F.col("pdt") <= F.col("ddt") + length)


def cell_rendezvous_compat(trips: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    """First dropoff (``ddt``) per taxi, cell and dropoff window, met with the
    first pickup (``pdt``) per taxi, cell and pickup window when
    ``ddt <= pdt <= ddt + window``.

    An interval join computed without a join: a pickup within one window
    length after a dropoff lies in the dropoff's window or the next one. So
    each pickup is keyed under its own window (``pdt_same``) and under the
    previous one (``pdt_next``), each dropoff under its window, and a single
    grouped ``min`` per (taxi, cell, window) yields the dropoff and both
    candidate pickups at once: one scan, one map-side combined shuffle, at
    most two output rows per dropoff window, whatever a taxi's history."""
    return rendezvous_pairs(rendezvous_firsts(rendezvous_rows(trips, window)), window)


def rendezvous_rows(trips: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    """Each trip as three keyed rows (taxi, cell, window start): its dropoff,
    its pickup as a same-window candidate, and its pickup as a next-window
    candidate of the previous window."""
    length = F.expr(f"INTERVAL {window}")
    t = trips.withColumn("_dw", F.window("dropoff_dt", window).start)
    t = t.withColumn("_pw", F.window("pickup_dt", window).start)
    no_ts = F.lit(None).cast(trips.schema["pickup_dt"].dataType)
    return t.select(
        "medallion",
        keyed_rows(
            ["cell", "bucket", "ddt", "pdt_same", "pdt_next"],
            [F.col("dropoff_cell"), F.col("_dw"), F.col("dropoff_dt"), no_ts, no_ts],
            [F.col("pickup_cell"), F.col("_pw"), no_ts, F.col("pickup_dt"), no_ts],
            [F.col("pickup_cell"), F.col("_pw") - length, no_ts, no_ts, F.col("pickup_dt")],
        ),
    )


def rendezvous_firsts(rows: DataFrame) -> DataFrame:
    """Per (taxi, cell, window): first dropoff and first pickup of this and
    of the next window."""
    return (
        rows.groupBy("medallion", "cell", "bucket")
        .agg(F.min("ddt").alias("ddt"), F.min("pdt_same").alias("pdt_same"), F.min("pdt_next").alias("pdt_next"))
        .where(F.col("ddt").isNotNull())
    )


def rendezvous_pairs(firsts: DataFrame, window: str = RENDEZVOUS_WINDOW) -> DataFrame:
    length = F.expr(f"INTERVAL {window}")
    pairs = firsts.select(
        "medallion", "cell", "ddt", F.explode(F.array("pdt_same", "pdt_next")).alias("pdt")
    )
    return pairs.where((F.col("pdt") >= F.col("ddt")) & (F.col("pdt") <= F.col("ddt") + length))
