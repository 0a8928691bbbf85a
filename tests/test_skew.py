"""One taxi holding a third of all trips: the order-dependent queries stay
exact (checked against a plain window brute force) and the hot taxi is cut
into blocks of which none holds much of it."""

from pyspark.sql import Window, functions as F

from cabgrid import operators as ops
from cabgrid.functions import seconds_between
from cabgrid.plans import derived_trips
from conftest import SF01


def _hot_trips(spark):
    t = derived_trips(spark, SF01)
    # a pseudo-random third of all trips (a modulo on the id would give the
    # hot taxi an arithmetic progression of durations with no peaks)
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    return t.withColumn("medallion", F.when(hot, F.lit("HOT")).otherwise(F.col("medallion")))


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_idle_gaps_exact_under_skew(spark):
    trips = _hot_trips(spark)
    got = ops.idle_gaps(trips)
    w = Window.partitionBy("medallion").orderBy("pickup_dt", "event_id")
    prev = F.lag("dropoff_dt").over(w)
    exp = (
        trips.select("medallion", "event_id", "pickup_dt", prev.alias("prev_dropoff_dt"))
        .where(F.col("prev_dropoff_dt").isNotNull())
        .withColumn("gap_seconds", seconds_between("prev_dropoff_dt", "pickup_dt").cast("int"))
    )
    assert _rows(got) == _rows(exp)


def test_congestion_exact_under_skew(spark):
    trips = _hot_trips(spark)
    got = ops.congestion_alerts(trips)
    day = F.window("pickup_dt", "1 day").start
    base = trips.select("medallion", day.alias("day"), "pickup_dt", "event_id", "trip_time", "pickup_cell")
    w = Window.partitionBy("medallion", "day").orderBy("pickup_dt", "event_id")
    d = F.col("trip_time")
    s = base.select(
        "*",
        F.lag(d, 1).over(w).alias("b1"),
        F.lead(d, 1).over(w).alias("a1"),
        F.lead(d, 2).over(w).alias("a2"),
        F.lead(d, 3).over(w).alias("a3"),
    ).where((d > F.col("b1")) & (d > F.col("a1")) & (F.col("a1") < F.col("a2")) & (F.col("a2") < F.col("a3")))
    first = s.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    exp = first.select(
        "medallion", "day", F.col("pickup_cell").alias("cell"),
        F.concat(F.lit("Alert, area "), F.col("pickup_cell"), F.lit(" is congested")).alias("alert_message"),
    )
    assert got.where(F.col("medallion") == "HOT").count() > 0
    assert _rows(got) == _rows(exp)


def test_rendezvous_of_a_very_busy_taxi_hour(spark):
    """A million trips of one taxi in one cell and hour: no row gathers them."""
    n = 1_000_000
    second = (F.col("id") * 7919 % 3600).cast("int")
    hour = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    at = lambda s: hour + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s)
    trips = spark.range(n).select(
        F.lit("HOT").alias("medallion"), F.col("id").alias("event_id"), F.lit("1.1").alias("pickup_cell"), F.lit("1.1").alias("dropoff_cell"),
        at(second - second % 2).alias("pickup_dt"), at(second).alias("dropoff_dt"),
    )
    got = ops.cell_rendezvous(trips)
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()
    wait = seconds_between("ddt", "pdt")
    r = got.agg(F.count("*").alias("n"), F.min(wait).alias("lo"), F.max(wait).alias("hi"), F.sum(wait).alias("total")).first()
    last = trips.where(F.minute("dropoff_dt") * 60 + F.second("dropoff_dt") == 3599).count()
    odd = trips.where(F.second("dropoff_dt") % 2 == 1).count() - last
    assert (r.n, r.lo, r.hi, r.total) == (n - last, 0, 1, odd)


def test_hot_taxi_is_cut_into_blocks(spark):
    trips = _hot_trips(spark).where("medallion = 'HOT'")
    total = trips.count()
    days = trips.groupBy(F.to_date("pickup_dt")).count().agg(F.max("count")).first()[0]
    hours = trips.groupBy(F.window("pickup_dt", "1 hour")).count().agg(F.max("count")).first()[0]
    assert days < total / 15 and hours < total / 200
