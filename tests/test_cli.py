"""The command line runs batch queries over tables or trip files and
streaming queries over a landing folder, stopped and started again."""

import os
import subprocess
import sys

import tempfile

from cabgrid.__main__ import main
from cabgrid.plans import raw_trip_table
from cabgrid.session import checkpoint_root
from cabgrid.sources import trip_lines
from conftest import ROOT, SF001


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_batch_and_stream_commands(spark):
    d = tempfile.mkdtemp(prefix="cli-", dir=checkpoint_root(spark).replace("file:", ""))
    trip_lines(raw_trip_table(spark, SF001)).select("value").coalesce(1).write.text(f"{d}/landing")

    assert main(["batch", "driver_tips", "--tables", SF001, "--out", f"{d}/a"]) == 0
    assert main(["batch", "driver_tips", "--trips", f"{d}/landing", "--format", "text", "--out", f"{d}/b"]) == 0
    a, b = spark.read.parquet(f"{d}/a"), spark.read.parquet(f"{d}/b")
    assert a.count() > 0 and _rows(a) == _rows(b)

    rc = main(
        ["stream", "stream_route_counts", "--source", f"{d}/landing", "--format", "text",
         "--out", f"{d}/s", "--checkpoint", f"{d}/ck", "--available-now"]
    )
    assert rc == 0 and spark.read.parquet(f"{d}/s").count() > 0


def test_a_stream_goes_on_in_the_next_process(spark):
    """Two runs in two processes, with only spark.checkpoint.dir set, give what
    one run over all input gives."""
    d = tempfile.mkdtemp(prefix="cli2-", dir=checkpoint_root(spark).replace("file:", ""))
    lines = trip_lines(raw_trip_table(spark, SF001)).orderBy("event_id")
    first, second = lines.where("event_id < 500"), lines.where("event_id >= 500")

    def run(name: str) -> None:
        code = "import sys; from pyspark.sql import SparkSession; from cabgrid.__main__ import main; sys.exit(main(sys.argv[1:]))"
        conf = f"--master local[2] --conf spark.ui.enabled=false --conf spark.sql.session.timeZone=UTC --conf spark.sql.shuffle.partitions=4 --conf spark.checkpoint.dir={d}/{name}-ckpt pyspark-shell"
        env = os.environ | {"PYSPARK_SUBMIT_ARGS": conf, "PYTHONPATH": ROOT}
        args = ["stream", "stream_route_counts", "--source", f"{d}/{name}", "--format", "text", "--out", f"{d}/{name}-out", "--available-now"]
        done = subprocess.run([sys.executable, "-c", code, *args], env=env, cwd=d, capture_output=True, text=True, timeout=240)
        assert done.returncode == 0, done.stderr[-2000:]

    first.select("value").coalesce(1).write.mode("append").text(f"{d}/two")
    run("two")
    second.select("value").coalesce(1).write.mode("append").text(f"{d}/two")
    run("two")
    first.select("value").coalesce(1).write.mode("append").text(f"{d}/one")
    second.select("value").coalesce(1).write.mode("append").text(f"{d}/one")
    run("one")
    two, one = (spark.read.parquet(f"{d}/{n}-out") for n in ("two", "one"))
    assert _rows(two) == _rows(one) and one.count() > 0


def test_a_stream_needs_a_checkpoint_folder(spark):
    import pytest

    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        pytest.skip("the session names a checkpoint folder")
    with pytest.raises(SystemExit):
        main(["stream", "stream_route_counts", "--source", "/nowhere", "--out", "/nowhere"])
