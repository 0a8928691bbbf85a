"""Identities between queries and invariance to input layout."""

from pyspark.sql import functions as F

from cabgrid import operators as ops
from cabgrid.functions import (
    avg_of_cents,
    congested_message,
    grid_cell,
    idle_message,
    inside_grid,
    register_sql_functions,
    sum_of_cents,
    wrapped_minutes,
)
from cabgrid.plans import derived_trips
from cabgrid.plans.catalog import cent_trips, raw_trip_table
from conftest import SF001, SF01


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_sql_form_equals_dataframe_form(spark):
    trips = derived_trips(spark, SF01)
    assert _rows(ops.profitable_areas(trips)) == _rows(ops.profitable_areas_sql(trips))


def test_route_counts_cover_all_trips(spark):
    trips = derived_trips(spark, SF01)
    total = ops.route_counts(trips).agg(F.sum("num_trips")).first()[0]
    assert total == trips.count()


def test_tips_cover_all_trips(spark):
    trips = derived_trips(spark, SF01)
    a = ops.driver_tips(trips).agg(F.sum("total_tip_amount")).first()[0]
    b = trips.agg(F.sum("tip_amount")).first()[0]
    assert a == b


def test_results_ignore_input_partitioning(spark):
    trips = derived_trips(spark, SF001)
    shuffled = trips.repartition(13, F.rand(3))
    for fn in (ops.idle_alerts, ops.congestion_alerts, ops.cell_rendezvous, ops.top_routes_per_window):
        assert _rows(fn(trips)) == _rows(fn(shuffled)), fn.__name__


def test_sums_of_cents_ignore_the_order_of_rows(spark):
    trips = cent_trips(spark, SF01)
    for fn in (ops.driver_tips, ops.area_profit, ops.pleasant_drivers):
        want = _rows(fn(trips, cents=True))
        assert want
        for n in (1, 2, 5, 11, 23):
            assert _rows(fn(trips.repartition(n, F.rand(n)), cents=True)) == want, (fn.__name__, n)


def test_cents_of_no_amount(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 0.29), (2, 0.1), (2, None)], "k int, x double")
    got = rows.groupBy("k").agg(sum_of_cents("x"), avg_of_cents("x")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, None, None), (2, 0.39, 0.195)]


def test_sql_functions_equal_the_columns(spark):
    register_sql_functions(spark)
    points = spark.createDataFrame(
        [(-74.913585, 41.474937, -60, 12.345), (-80.0, 41.0, 86461, 10.0), (None, 41.0, None, None), (-73.120784, 40.129716, -86400, 0.005)],
        "lon double, lat double, s long, m double",
    )
    pairs = {
        "cab_cell(lon, lat)": grid_cell("lon", "lat"),
        "cab_inside(lon, lat)": inside_grid("lon", "lat"),
        "cab_wrapped_minutes(s)": wrapped_minutes("s"),
        "cab_idle_message(m)": idle_message("m"),
        "cab_congested_message(cast(s AS STRING))": congested_message(F.col("s").cast("string")),
    }
    for text, column in pairs.items():
        for r in points.select(F.expr(text).alias("a"), column.alias("b")).collect():
            assert r.a == r.b, (text, r)


def test_parameters_of_sql_text(spark):
    raw, trips = raw_trip_table(spark, SF001), derived_trips(spark, SF001)
    assert _rows(ops.top_routes_sql(raw, 3)) == _rows(ops.top_routes(trips, 3))
    assert _rows(ops.pleasant_drivers_sql(raw, 4)) == _rows(ops.pleasant_drivers(trips, 4))
    assert _rows(ops.idle_compat_sql(raw, 30)) == _rows(ops.idle_compat(trips, threshold=30))


def test_distinct_taxis_option(spark):
    trips = derived_trips(spark, SF01)
    got = ops.profitable_areas(trips, distinct_taxis=True)
    e = ops.empty_taxis(trips, distinct_taxis=True)
    p = ops.area_profit(trips)
    exp = p.join(e, (p.pickup_cell == e.dropoff_cell) & (p.window_end == e.window_end)).select(
        p.pickup_cell.alias("cell"), p.window_end, p.area_profit, e.num_empty_taxis,
        (p.area_profit / e.num_empty_taxis).alias("profitability"),
    )
    assert _rows(got) == _rows(exp)
    assert got.count() > 0


def test_operators_on_empty_input(spark):
    empty = derived_trips(spark, SF001).limit(0)
    for name in ops.__all__:
        fn = getattr(ops, name)
        if name in ("with_neighbors", "top_k", "top_k_per_group", "clean_trips"):
            continue
        assert fn(empty).count() == 0, name


def test_peak_lead_form_equals_array_form(spark):
    """Brute force on a small fixture: the whole taxi-day as a sorted array,
    first index matching the pattern found with higher-order functions."""
    trips = derived_trips(spark, SF001)
    arr = trips.groupBy("medallion", F.window("pickup_dt", "1 day").start.alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("pickup_dt", "event_id", "trip_time", "pickup_cell"))).alias("a")
    )
    hits = arr.select(
        "medallion",
        "day",
        "a",
        F.expr(
            """CASE WHEN size(a) >= 5 THEN filter(sequence(1, size(a) - 4), i ->
                 a[i].trip_time > a[i - 1].trip_time AND a[i].trip_time > a[i + 1].trip_time
                 AND a[i + 1].trip_time < a[i + 2].trip_time AND a[i + 2].trip_time < a[i + 3].trip_time)
               ELSE array() END"""
        ).alias("hits"),
    ).where(F.size("hits") > 0)
    exp = hits.select("medallion", "day", F.expr("a[hits[0]].pickup_cell").alias("cell"))
    got = ops.congestion_alerts(trips).select("medallion", "day", "cell")
    assert exp.count() > 0
    assert _rows(got) == _rows(exp)


def test_batch_results_ignore_session_time_zone(spark):
    trips = derived_trips(spark, SF001)
    fns = (ops.route_counts, ops.driver_tips, ops.idle_alerts, ops.congestion_alerts, ops.profitable_areas)
    base = {fn.__name__: _rows(fn(trips)) for fn in fns}
    for zone in ("Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for fn in fns:
                assert _rows(fn(derived_trips(spark, SF001))) == base[fn.__name__], (zone, fn.__name__)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
