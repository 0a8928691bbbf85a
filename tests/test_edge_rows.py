"""Hand-written edge rows: parsing, cleaning, grid bounds, wrap arithmetic and
the congestion pattern."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabgrid import clean_trips, congestion_alerts, congestion_compat, parse_trips
from cabgrid.functions import seconds_between, wrapped_minutes
from cabgrid.schema import LINE_FIELDS

GOOD = {
    "medallion": "M1",
    "pickup_dt": "2024-01-01 10:00:00",
    "dropoff_dt": "2024-01-01 10:10:00",
    "trip_time": "600",
    "trip_distance": "1.5",
    "pickup_long": "-73.95",
    "pickup_lat": "40.75",
    "dropoff_long": "-73.96",
    "dropoff_lat": "40.76",
    "fare_amount": "10.0",
    "tip_amount": "2.0",
    "total_amount": "12.0",
}


def line(**over):
    vals = dict(GOOD, **over)
    parts = ["x"] * 17
    for name, pos in LINE_FIELDS.items():
        parts[pos] = vals[name]
    return ",".join(parts)


def parse(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id long, value string")
    return parse_trips(df, id_col="id")


def test_good_line_round_trip(spark):
    r = parse(spark, [line()]).collect()[0]
    assert r.reject_reason is None
    assert r.medallion == "M1" and r.trip_time == 600 and r.fare_amount == 10.0
    assert r.pickup_dt == dt.datetime(2024, 1, 1, 10, 0, 0)


@pytest.mark.parametrize(
    "text,reason",
    [
        ("", "empty_line"),
        ("a,b,c", "too_few_fields"),
        (line(pickup_long="abc"), "bad_field"),
        (line(trip_time="1.0"), "bad_field"),
        (line(pickup_dt="yesterday"), "bad_field"),
    ],
)
def test_rejects(spark, text, reason):
    r = parse(spark, [text]).collect()[0]
    assert r.reject_reason == reason
    assert clean_trips(parse(spark, [text])).count() == 0


@pytest.mark.parametrize(
    "over",
    [
        {"pickup_long": "nan"},
        {"pickup_long": "0", "pickup_lat": "0"},
        {"dropoff_long": "0"},
        {"dropoff_lat": "41.5"},
        {"pickup_long": "-73.0"},
    ],
)
def test_dropped_outside_grid(spark, over):
    parsed = parse(spark, [line(**over)])
    assert parsed.collect()[0].reject_reason is None
    assert clean_trips(parsed).count() == 0


@pytest.mark.parametrize(
    "lon,lat,cell",
    [
        ("-74.913585", "41.474937", "1.1"),
        ("-74.916578", "41.474937", "0.1"),
        ("-73.120784", "41.474937", "300.1"),
        ("-74.913585", "41.477183", "1.0"),
        ("-74.913585", "40.129716", "1.300"),
    ],
)
def test_grid_bounds(spark, lon, lat, cell):
    out = clean_trips(parse(spark, [line(pickup_long=lon, pickup_lat=lat)])).collect()
    assert len(out) == 1 and out[0].pickup_cell == cell


def test_wrapped_minutes_table(spark):
    seconds = [0, 30, 60, 600, 1800, 3540, 3600, 5400]
    expected = [0, 59, 59, 50, 30, 1, 0, 30]
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(t0, t0 + dt.timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(rows, "pickup_dt timestamp_ntz, dropoff_dt timestamp_ntz")
    got = df.select(wrapped_minutes(seconds_between("dropoff_dt", "pickup_dt")).alias("m")).collect()
    assert [r.m for r in got] == expected


def _taxi_day(spark, durations):
    t0 = dt.datetime(2024, 1, 5, 6, 0, 0)
    rows = [
        (i, "M7", t0 + dt.timedelta(minutes=60 * i), d, f"{i + 1}.1")
        for i, d in enumerate(durations)
    ]
    return spark.createDataFrame(rows, "event_id long, medallion string, pickup_dt timestamp_ntz, trip_time int, pickup_cell string")


@pytest.mark.parametrize(
    "durations,cell",
    [
        ([5, 9, 3, 4, 6], "2.1"),
        ([5, 9, 3, 4, 4], None),
        ([5, 9, 3, 4], None),
        ([9, 3, 4, 6], None),
        ([5, 9, 3, 4, 6, 2, 3, 4], "2.1"),
    ],
)
def test_congestion_pattern(spark, durations, cell):
    trips = _taxi_day(spark, durations)
    got = congestion_alerts(trips).collect()
    if cell is None:
        assert got == []
    else:
        assert len(got) == 1 and got[0].cell == cell
        assert got[0].alert_message == f"Alert, area {cell} is congested"
    compat = congestion_compat(trips).collect()
    assert [r.alert_message for r in compat] == ["No congested Areas"]


@pytest.mark.parametrize("slide", ["5 seconds", "1 minute", "30 minutes"])
def test_idle_sliding_window(spark, slide):
    """Every window of every slide that holds a gap, against brute force."""
    from cabgrid import idle_alerts, idle_gaps
    from cabgrid.operators.idle import duration_seconds
    from cabgrid.plans import derived_trips

    trips = derived_trips(spark, "/root/testdata/sf0.001").where("medallion < 'M12'")
    step, sums = duration_seconds(slide), {}
    for g in idle_gaps(trips).where("gap_seconds > 0").collect():
        at = int((g.pickup_dt - dt.datetime(1970, 1, 1)).total_seconds()) // step
        for k in range(3600 // step):
            total = sums.setdefault((g.medallion, (at - k) * step), [0, 0])
            total[0] += g.gap_seconds
            total[1] += 1
    want = {
        (m, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=w)): s / n / 60 for (m, w), (s, n) in sums.items() if s / n / 60 > 10
    }
    got = {(r.medallion, r.window_start): r.avg_idle_minutes for r in idle_alerts(trips, "1 hour", slide=slide).collect()}
    assert got == want and want


@pytest.mark.parametrize("slide", ["5 seconds", "1 minute", "5 minutes", "1 hour"])
def test_stretches_expand_to_the_sliding_windows(spark, slide):
    """And they are the longest: no two that touch have the same mean."""
    from cabgrid import idle_alert_stretches, idle_alerts
    from cabgrid.operators.idle import duration_seconds
    from cabgrid.plans import derived_trips

    trips = derived_trips(spark, "/root/testdata/sf0.001").where("medallion < 'M12'")
    step = dt.timedelta(seconds=duration_seconds(slide))
    rows = sorted(map(tuple, idle_alert_stretches(trips, slide=slide).collect()))
    got = {}
    for m, first, last, mean in rows:
        for k in range((last - first) // step + 1):
            assert (m, first + k * step) not in got
            got[(m, first + k * step)] = mean
    want = {(r.medallion, r.window_start): r.avg_idle_minutes for r in idle_alerts(trips, slide=slide).collect()}
    assert got == want and want
    if slide != "1 hour":  # windows that don't overlap
        assert len(rows) < len(want) and any(a.date() != b.date() for _, a, b, _ in rows)
    assert not any(a[0] == b[0] and a[2] + step == b[1] and a[3] == b[3] for a, b in zip(rows, rows[1:]))
    with pytest.raises(ValueError):
        idle_alert_stretches(trips, slide="7 seconds")


def test_durations():
    from cabgrid.operators.idle import duration_seconds

    assert [duration_seconds(d) for d in ("5 seconds", "1 hour 30 minutes", "2 Days")] == [5, 5400, 172800]
    for bad in ("", "hour", "1 fortnight", "1 hour 30"):
        with pytest.raises(ValueError):
            duration_seconds(bad)


def test_windows_are_whole_numbers_of_slides(spark):
    from cabgrid import idle_alerts

    with pytest.raises(ValueError):
        idle_alerts(_taxi_day(spark, [1, 2]).withColumn("dropoff_dt", F.col("pickup_dt")), "1 hour", slide="7 seconds")


@pytest.mark.parametrize(
    "stamp", ["2024", "2024-01", "2024-01-01", "2024-01-01T10:00:00", "2024-01-01 10:00:00.5", "2024-01-01 10:00:00+05:00", "2024-13-01 10:00:00", "24-01-01 10:00:00"]
)
def test_only_the_line_format_is_a_timestamp(spark, stamp):
    r = parse(spark, [line(pickup_dt=stamp)]).collect()[0]
    assert r.reject_reason == "bad_field" and r.pickup_dt is None


def test_a_line_is_split_once(spark, capsys):
    lines = spark.createDataFrame([(1, line())], "id long, value string")
    clean_trips(parse_trips(lines, id_col="id")).select("pickup_cell", "fare_amount").explain()
    assert capsys.readouterr().out.count("split(") == 1


def _visits(spark, trips):
    """Trips of one taxi as (pickup cell, pickup minute, dropoff cell, dropoff minute)."""
    t0 = dt.datetime(2024, 1, 5, 10, 0, 0)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    rows = [(i, "M1", at(p), at(d), a, b) for i, (a, p, b, d) in enumerate(trips)]
    return spark.createDataFrame(
        rows, "event_id long, medallion string, pickup_dt timestamp_ntz, dropoff_dt timestamp_ntz, pickup_cell string, dropoff_cell string"
    )


def test_rendezvous_is_the_next_pickup_in_the_cell(spark):
    from cabgrid import cell_rendezvous, cell_rendezvous_compat

    # picked up in A at 10:05, dropped off in A at 10:20, picked up in A at 10:40
    trips = _visits(spark, [("A", 5, "B", 12), ("B", 13, "A", 20), ("A", 40, "C", 55), ("A", 81, "C", 90)])
    got = [(r.event_id, r.ddt.minute, r.pdt.minute) for r in cell_rendezvous(trips).where("cell = 'A'").collect()]
    assert got == [(1, 20, 40)]
    assert cell_rendezvous_compat(trips).where("cell = 'A'").collect() == []
    late = _visits(spark, [("B", 13, "A", 20), ("A", 80, "C", 90)])  # exactly one hour
    assert [r.pdt.hour for r in cell_rendezvous(late).collect()] == [11]
    assert cell_rendezvous(_visits(spark, [("B", 13, "A", 20), ("A", 81, "C", 90)])).collect() == []
