"""Benchmark: every batch query over the tables in $BENCH_SF_DIR on
local[$BENCH_CPUS]. Each query is run to completion into Spark's ``noop``
sink (full execution, nothing collected), once to warm up and then
$BENCH_REPEATS times; the median is reported. All queries are warmed up
before any is timed; the value is the sum over all of them. Each streaming
query is run once, apart from that sum. Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabgrid.plans import QUERIES, STREAM_QUERIES  # noqa: E402
from cabgrid.session import local_session  # noqa: E402

def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def run_stream(spark, name: str, sf_dir: str) -> float:
    """A full streaming run over the events table, including reading back its output."""
    t = time.perf_counter()
    STREAM_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else "8")))
    # Warm every query up first, so JIT state does not depend on query order.
    for name in names:
        run_once(spark, name, sf_dir)
    per_query = {}
    for name in names:
        per_query[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 4)
    streaming = {}
    if os.environ.get("BENCH_STREAMING", "1") == "1":
        for name in STREAM_QUERIES:
            streaming[name] = round(run_stream(spark, name, sf_dir), 4)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "sum_median_query_sec",
        "value": round(sum(per_query.values()), 4),
        "unit": "sec",
        "queries": per_query,
        "stream_queries": streaming,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
