"""Streaming behaviour beyond the oracle runs: out-of-order arrival inside the
watermark delay, late rows, restart from a checkpoint, state that goes away,
empty input, messages."""

import datetime as dt
import os
import tempfile
from functools import partial
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cabgrid import operators as ops
from cabgrid.plans import raw_trip_table
from cabgrid.plans.streaming_queries import BUILDERS
from cabgrid.schema import TRIP_COLUMNS, TRIP_SCHEMA
from cabgrid.session import checkpoint_root
from cabgrid.sources import parse_trips, reject_counts, trip_lines
from cabgrid.streaming import (
    BatchBanner,
    best_so_far,
    observed_outcomes,
    read_best,
    read_trip_stream,
    routes_order,
    stream_congestion_alerts,
    stream_idle_alerts,
    stream_idle_alerts_sliding,
    stream_outcomes,
    stream_profitable_areas,
    stream_route_counts,
    trips_of_messages,
    write_stream,
)
from conftest import SF001

BATCH = {
    "stream_route_counts": ops.route_counts,
    "stream_top_routes": ops.top_routes_per_window,
    "stream_profitable_areas": ops.profitable_areas,
    "stream_profitable_areas_distinct": partial(ops.profitable_areas, distinct_taxis=True),
    "stream_idle_alerts": ops.idle_alerts,
    "stream_idle_alerts_sliding": partial(ops.idle_alerts, slide="5 minutes"),
    "stream_idle_compat": ops.idle_compat,
    "stream_congestion_alerts": ops.congestion_alerts,
    "stream_cell_rendezvous": ops.cell_rendezvous,
    "stream_cell_rendezvous_compat": ops.cell_rendezvous_compat,
    "stream_pleasant_drivers": ops.pleasant_drivers_per_day,
}


def _scratch(spark):
    return tempfile.mkdtemp(prefix="stream-test-", dir=checkpoint_root(spark).replace("file:", ""))


def _add(trips, path):
    """One more input file."""
    trips.select(*TRIP_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def _add_slices(trips, path, slices):
    lo, hi = trips.agg(F.min("pickup_dt"), F.max("pickup_dt")).first()
    step = (hi - lo) / slices
    for k in range(slices):
        part = trips.where(F.col("pickup_dt") >= F.lit(lo + step * k))
        _add(part.where(F.col("pickup_dt") < F.lit(lo + step * (k + 1))) if k < slices - 1 else part, path)


def _add_flush(trips, path):
    """A trip far ahead, of a taxi of its own."""
    far = trips.orderBy("event_id").limit(1)
    years = F.expr("INTERVAL 3650 DAYS")
    _add(far.withColumn("medallion", F.lit("~")).withColumn("pickup_dt", F.col("pickup_dt") + years).withColumn("dropoff_dt", F.col("dropoff_dt") + years), path)


def _run(spark, src, build, out_dir, ckpt, per_batch=None):
    q = write_stream(build(read_trip_stream(spark, src, max_files_per_trigger=1)), out_dir, ckpt, per_batch=per_batch, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    if not os.path.exists(out_dir):
        return None
    out = spark.read.parquet(out_dir)
    return out.drop("batch_id") if per_batch else out


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def _first_days(spark, days):
    raw = raw_trip_table(spark, SF001)
    lo = raw.agg(F.min("pickup_dt")).first()[0].replace(hour=0, minute=0, second=0)
    return raw.where(F.col("pickup_dt") < F.lit(lo + dt.timedelta(days=days))), lo


@pytest.mark.parametrize("name", list(BATCH))
def test_rows_just_inside_the_delay_count(spark, name):
    """Every other row arrives 2 h 55 min after the newest pickup; none is lost."""
    raw = raw_trip_table(spark, SF001)
    lo = raw.agg(F.min("pickup_dt")).first()[0]
    # times two minutes apart, so that 2 h 55 min is many trips
    squeezed = raw.withColumn("n", F.col("event_id")).where("event_id < 600")
    shift = lambda c: F.lit(lo) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("n") * 120 + F.when(F.lit(c == "dropoff_dt"), F.col("trip_time")).otherwise(0))
    squeezed = squeezed.withColumn("pickup_dt", shift("pickup_dt")).withColumn("dropoff_dt", shift("dropoff_dt")).drop("n")
    d = _scratch(spark)
    edges = [lo + dt.timedelta(minutes=175 * k) for k in range(8)]
    for a, b in zip(edges, edges[1:]):
        part = squeezed.where((F.col("pickup_dt") >= F.lit(a)) & (F.col("pickup_dt") < F.lit(b)))
        _add(part.where("event_id % 2 = 1"), f"{d}/in")  # ahead of ...
        _add(part.where("event_id % 2 = 0"), f"{d}/in")  # ... what is up to 2 h 55 min older
    _add_flush(squeezed, f"{d}/in")
    build, per_batch = BUILDERS[name]
    got = _run(spark, f"{d}/in", build, f"{d}/out", f"{d}/ck", per_batch)
    want = BATCH[name](ops.clean_trips(squeezed.where(F.col("pickup_dt") < F.lit(edges[-1]))))
    assert want.count() > 0 and _rows(got) == _rows(want)


def test_a_delay_must_be_positive(spark):
    trips = read_trip_stream(spark, _scratch(spark))
    for name, (build, _) in BUILDERS.items():
        with pytest.raises(ValueError):
            build(trips, delay="0 seconds")


@pytest.mark.parametrize("name", ["stream_idle_alerts", "stream_idle_alerts_sliding", "stream_congestion_alerts"])
def test_keyed_state_handles_out_of_order_files(spark, name):
    """Slices arrive pairwise swapped; with a delay longer than two slices no
    row is late, and the keyed state still produces the batch answer."""
    raw, lo = _first_days(spark, 4)
    raw = raw.withColumn("medallion", F.concat(F.lit("M"), F.pmod(F.xxhash64("event_id"), F.lit(3))))
    d = _scratch(spark)
    step = dt.timedelta(hours=6)
    for k in [j for i in range(0, 16, 2) for j in (i + 1, i)]:
        _add(raw.where((F.col("pickup_dt") >= F.lit(lo + step * k)) & (F.col("pickup_dt") < F.lit(lo + step * (k + 1)))), f"{d}/in")
    _add_flush(raw, f"{d}/in")
    build, _ = BUILDERS[name]
    got = _run(spark, f"{d}/in", lambda s: build(s, delay="13 hours"), f"{d}/out", f"{d}/ck")
    want = BATCH[name](ops.clean_trips(raw))
    assert want.count() > 0 and _rows(got) == _rows(want)


@pytest.mark.parametrize("name", ["stream_idle_alerts", "stream_idle_alerts_sliding", "stream_congestion_alerts"])
def test_pickups_between_milliseconds(spark, name):
    """A pickup a few hundred microseconds past the watermark is only waited for."""
    raw, _ = _first_days(spark, 6)
    us = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.lit(500) + F.col("event_id") % 499) / F.lit(1e6))
    raw = raw.withColumn("pickup_dt", F.col("pickup_dt") + us).withColumn("medallion", F.concat(F.lit("M"), F.pmod(F.xxhash64("event_id"), F.lit(3))))
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 5)
    _add_flush(raw, f"{d}/in")
    build, _ = BUILDERS[name]
    got = _run(spark, f"{d}/in", lambda s: build(s, delay="1 second"), f"{d}/out", f"{d}/ck")
    want = BATCH[name](ops.clean_trips(raw))
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize(
    "build", [stream_congestion_alerts, lambda s: stream_idle_alerts(s, forget_after="2 days")], ids=["congestion", "idle"]
)
def test_finished_keys_leave_the_state(spark, build):
    raw, _ = _first_days(spark, 10)
    raw = raw.withColumn("medallion", F.concat(F.date_format("pickup_dt", "dd"), F.pmod(F.xxhash64("event_id"), F.lit(3))))  # out for one day
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 5)
    q = write_stream(build(read_trip_stream(spark, f"{d}/in", max_files_per_trigger=1)), f"{d}/out", f"{d}/ck", available_now=True)
    q.awaitTermination()
    keyed = lambda: sum(o.numRowsTotal for o in q.lastProgress.stateOperators if "transform" in o.operatorName.lower())
    busy, taxis = keyed(), raw.select("medallion").distinct().count()
    _add_flush(raw, f"{d}/in")
    q = write_stream(build(read_trip_stream(spark, f"{d}/in", max_files_per_trigger=1)), f"{d}/out", f"{d}/ck", available_now=True)
    q.awaitTermination()
    assert taxis > 20 and 1 <= busy < taxis / 2
    assert keyed() == 0  # the flush taxi's hour never closes


def test_expired_panes_leave_the_ring(spark):
    """A taxi keeps its last dropoff; what its windows have left behind goes, and
    windows come out while the stream goes on, not at its end."""
    raw, lo = _first_days(spark, 6)
    raw = raw.withColumn("medallion", F.concat(F.lit("M"), F.pmod(F.xxhash64("event_id"), F.lit(4))))
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 5)
    run = lambda: write_stream(
        stream_idle_alerts_sliding(read_trip_stream(spark, f"{d}/in", max_files_per_trigger=1)), f"{d}/out", f"{d}/ck", available_now=True
    )
    q = run()
    q.awaitTermination()
    keyed = lambda p: sum(o.numRowsTotal for o in p.stateOperators if "transform" in o.operatorName.lower())
    sizes = [keyed(p) for p in q.recentProgress]
    panes = raw.select("medallion", F.window("pickup_dt", "5 minutes")).distinct().count()
    # by taxi: a last dropoff, an open window with its timer, and the panes of an hour
    assert 4 <= max(sizes) <= 4 * (3 + 12) < panes / 3
    early = spark.read.parquet(f"{d}/out").count()
    _add_flush(raw, f"{d}/in")
    q = run()
    q.awaitTermination()
    assert keyed(q.lastProgress) == 4  # the last dropoffs
    want = ops.idle_alerts(ops.clean_trips(raw), slide="5 minutes")
    assert _rows(spark.read.parquet(f"{d}/out")) == _rows(want) and 0 < early < want.count()


def test_sliding_windows_of_another_length(spark):
    raw, _ = _first_days(spark, 4)
    raw = raw.withColumn("medallion", F.lit("M1"))  # one taxi has every trip
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 3)
    _add_flush(raw, f"{d}/in")
    how = {"window": "2 hours", "slide": "30 minutes", "threshold": 3.0}
    got = _run(spark, f"{d}/in", lambda s: stream_idle_alerts_sliding(s, **how), f"{d}/out", f"{d}/ck")
    want = ops.idle_alerts(ops.clean_trips(raw), **how)
    assert want.count() > 0 and _rows(got) == _rows(want)
    with pytest.raises(ValueError):
        stream_idle_alerts_sliding(read_trip_stream(spark, f"{d}/in"), slide="7 minutes")


def test_outcomes_are_observed_and_dead_letters_kept(spark):
    raw, _ = _first_days(spark, 3)
    good = trip_lines(raw).select("value")
    bad = spark.createDataFrame([("",), ("a,b",), ("x," * 20,), (" ",), (None,)], "value string")
    d = _scratch(spark)
    good.coalesce(1).write.mode("append").text(f"{d}/in")
    bad.where("value is not null").coalesce(1).write.mode("append").text(f"{d}/in")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{d}/in")
    done = stream_outcomes(lines)
    q = write_stream(done, f"{d}/out", f"{d}/ck", available_now=True, partition_by=["outcome"])
    q.awaitTermination()
    want = {r.outcome: r.num_lines for r in reject_counts(parse_trips(good.unionByName(bad.where("value is not null")))).collect()}
    assert {k: n for k, n in observed_outcomes(q).items() if n} == want and len(want) >= 4
    out = spark.read.schema(done.schema).parquet(f"{d}/out")
    assert {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()} == want
    assert {r.line for r in out.where("outcome = 'too_few_fields' or outcome = 'empty_line'").collect()} == {"", "a,b", " "}
    assert out.where("outcome = 'accepted' and (line is not null or medallion is null)").count() == 0
    assert sorted(os.listdir(f"{d}/out"))[-1].startswith("outcome=")


def test_running_best_rows_survive_a_repeated_batch(spark):
    raw, _ = _first_days(spark, 6)
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 6)
    _add_flush(raw, f"{d}/in")
    merge = best_so_far(f"{d}/out", routes_order, 10)
    seen = {}

    def twice(batch, batch_id):
        seen[batch_id] = batch.collect()
        return merge(batch, batch_id)

    q = write_stream(stream_route_counts(read_trip_stream(spark, f"{d}/in", max_files_per_trigger=1)), f"{d}/out", f"{d}/ck", per_batch=twice, available_now=True)
    q.awaitTermination()
    want = _rows(ops.top_routes(ops.clean_trips(raw)))
    assert _rows(read_best(spark, f"{d}/out")) == want and sum(map(bool, seen.values())) >= 3
    last = max(n for n, rows in seen.items() if rows)
    schema = "pickup_cell string, dropoff_cell string, window_start timestamp_ntz, num_trips long"
    again = merge(spark.createDataFrame(seen[last], schema), batch_id=last)  # a batch that is run again
    assert _rows(again) == want
    assert len([f for f in os.listdir(f"{d}/out") if f.startswith("batch_id")]) <= 4
    assert read_best(spark, f"{d}/nothing") is None


def test_late_rows_are_dropped(spark):
    raw, lo = _first_days(spark, 6)
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 3)
    late = raw.where(F.col("pickup_dt") < F.lit(lo + dt.timedelta(days=1)))
    _add(late.withColumn("event_id", F.col("event_id") + 10**9), f"{d}/in")
    got = _run(spark, f"{d}/in", stream_route_counts, f"{d}/out", f"{d}/ck")
    trips = ops.clean_trips(raw)
    wm = trips.agg(F.max("pickup_dt")).first()[0] - dt.timedelta(hours=3)
    exp = ops.route_counts(trips).where(F.col("window_start") + F.expr("INTERVAL 30 MINUTES") <= F.lit(wm))
    assert _rows(got) == _rows(exp)


def test_restart_from_checkpoint(spark):
    raw, lo = _first_days(spark, 6)
    mid = F.lit(lo + dt.timedelta(days=3))
    d = _scratch(spark)
    _add_slices(raw.where(F.col("pickup_dt") < mid), f"{d}/in", 2)
    first = _run(spark, f"{d}/in", stream_idle_alerts, f"{d}/out", f"{d}/ck").count()
    _add_slices(raw.where(F.col("pickup_dt") >= mid), f"{d}/in", 2)
    got = _run(spark, f"{d}/in", stream_idle_alerts, f"{d}/out", f"{d}/ck")
    assert got.count() > first
    once = _run(spark, f"{d}/in", stream_idle_alerts, f"{d}/out1", f"{d}/ck1")
    assert _rows(got) == _rows(once)


def test_empty_input_gives_empty_result(spark):
    raw, _ = _first_days(spark, 1)
    d = _scratch(spark)
    _add(raw.limit(0), f"{d}/in")
    got = _run(spark, f"{d}/in", stream_route_counts, f"{d}/out", f"{d}/ck")
    assert got is None or got.count() == 0


def test_text_lines_and_messages(spark):
    """A landing folder of lines, and messages with a binary value, give the trips."""
    raw, _ = _first_days(spark, 2)
    d = _scratch(spark)
    lines = trip_lines(raw).select("value")
    lines.coalesce(1).write.text(f"{d}/text")
    lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("trips").alias("topic")).write.parquet(f"{d}/messages")
    messages = spark.readStream.schema("key binary, value binary, topic string").parquet(f"{d}/messages")
    for name, trips in (("t", read_trip_stream(spark, f"{d}/text", fmt="text")), ("m", trips_of_messages(messages))):
        q = trips.writeStream.format("memory").queryName(f"parsed_{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        got = spark.sql(f"SELECT * FROM parsed_{name}").drop("event_id")
        want = ops.clean_trips(raw).drop("event_id").withColumns({c: F.col(c).cast("timestamp") for c in ("pickup_dt", "dropoff_dt")})
        assert _rows(got) == _rows(want)


def test_kafka_source_without_connector_fails_clearly(spark):
    from cabgrid.streaming import read_trip_stream_kafka

    with pytest.raises(RuntimeError, match="Kafka source unavailable"):
        read_trip_stream_kafka(spark, "localhost:9092", "trips")


def test_interval_trigger_runs_batches(spark):
    """The standing query (a micro-batch per interval) takes files as they land."""
    import time

    raw, _ = _first_days(spark, 4)
    d = _scratch(spark)
    _add(raw.limit(0), f"{d}/in")
    q = write_stream(stream_route_counts(read_trip_stream(spark, f"{d}/in")), f"{d}/out", f"{d}/ck", interval="1 second")
    try:
        _add(raw, f"{d}/in")
        _add_flush(raw, f"{d}/in")
        want = _rows(ops.route_counts(ops.clean_trips(raw)))
        for _ in range(60):
            if os.path.exists(f"{d}/out/_spark_metadata") and len(_rows(spark.read.schema("pickup_cell string, dropoff_cell string, window_start timestamp_ntz, num_trips long").parquet(f"{d}/out"))) == len(want):
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert _rows(spark.read.parquet(f"{d}/out")) == want


def test_batch_banner_sees_every_batch(spark):
    raw, _ = _first_days(spark, 3)
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 3)
    build = lambda: stream_route_counts(read_trip_stream(spark, f"{d}/in", max_files_per_trigger=1))
    q = write_stream(build(), f"{d}/out", f"{d}/ck", available_now=True)
    q.awaitTermination()
    banner = BatchBanner(echo=False)
    for progress in q.recentProgress:
        banner.onQueryProgress(SimpleNamespace(progress=progress))
    # input rows are counted at the source, before cleaning
    assert sum(rows for _, _, rows in banner.batches) == raw.count()
    assert len({b for b, _, _ in banner.batches}) >= 3 and banner.batches.maxlen == 1000


def test_non_utc_session_warns(spark):
    from cabgrid.streaming import to_event_time

    raw, _ = _first_days(spark, 1)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.warns(UserWarning, match="time zone"):
            to_event_time(raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_batch_operator_per_micro_batch(spark):
    """The original's literal scope: a batch operator applied to every
    micro-batch alone (here the global top 10 routes of each batch)."""
    raw, _ = _first_days(spark, 6)
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 3)
    _run(spark, f"{d}/in", lambda s: s, f"{d}/out", f"{d}/ck", per_batch=ops.top_routes)
    out = spark.read.parquet(f"{d}/out")
    per_batch = {r["batch_id"]: r["n"] for r in out.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert len(per_batch) == 3 and all(0 < n <= 10 for n in per_batch.values())


def test_per_batch_output_is_parquet_only(spark):
    trips = spark.readStream.schema(TRIP_SCHEMA).parquet(_scratch(spark))
    with pytest.raises(ValueError):
        write_stream(trips, "out", "ck", per_batch=ops.top_routes, fmt="console")


def test_stream_distinct_taxis_never_exceed_dropoffs(spark):
    raw, _ = _first_days(spark, 4)
    d = _scratch(spark)
    _add_slices(raw, f"{d}/in", 2)
    trips = _run(spark, f"{d}/in", stream_profitable_areas, f"{d}/a", f"{d}/cka")
    taxis = _run(spark, f"{d}/in", lambda s: stream_profitable_areas(s, distinct_taxis=True), f"{d}/b", f"{d}/ckb")
    a = {(r.cell, r.window_end): r.num_empty_taxis for r in trips.collect()}
    b = {(r.cell, r.window_end): r.num_empty_taxis for r in taxis.collect()}
    assert a and a.keys() == b.keys()
    assert all(0 < b[k] <= a[k] for k in a)
