"""Command line: run a batch query over a table directory, or a streaming
query over a landing folder (or Kafka topic), writing parquet.

    python -m cabgrid list
    python -m cabgrid explain cell_rendezvous --tables /data/sf1
    python -m cabgrid batch profitable_areas --tables /data/sf1 --out /out/areas
    python -m cabgrid batch idle_alerts --trips /data/trips/*.csv.gz --format text --out /out/idle
    python -m cabgrid batch top_routes --trips /warehouse/trips --format table \\
        --start 2024-01-01 --end 2024-01-31 --out /out/routes
    python -m cabgrid stream stream_idle_alerts --source /landing/trips --format text \\
        --out /out/idle --checkpoint /ckpt/idle [--available-now]

The session comes from ``spark-submit`` / the cluster defaults; nothing here
sets cluster resources.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from cabgrid.operators import clean_trips
from cabgrid.plans import BUILDERS, QUERIES, TRIP_OPERATORS
from cabgrid.schema import TRIP_SCHEMA
from cabgrid.sources import read_trip_table, read_trips
from cabgrid.streaming import read_trip_stream, read_trip_stream_kafka, write_stream


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cabgrid")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    e = sub.add_parser("explain")
    e.add_argument("query", choices=sorted(QUERIES))
    e.add_argument("--tables", required=True)
    b = sub.add_parser("batch")
    b.add_argument("query", choices=sorted(QUERIES))
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with events.parquet (trips derived from events)")
    src.add_argument("--trips", help="trip files: text lines, a parquet trip table, or a date-partitioned table")
    b.add_argument("--format", default="text", choices=["text", "parquet", "table"])
    b.add_argument("--start", help="first pickup date (format table)")
    b.add_argument("--end", help="last pickup date (format table)")
    b.add_argument("--min-partitions", type=int, help="spread single-split (gzip) text input")
    b.add_argument("--out", required=True)
    s = sub.add_parser("stream")
    s.add_argument("query", choices=sorted(BUILDERS))
    s.add_argument("--source", help="landing folder of trip files")
    s.add_argument("--format", default="text", choices=["text", "parquet"])
    s.add_argument("--kafka-servers")
    s.add_argument("--topic")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", help="defaults to <spark.checkpoint.dir>/<query>")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int)
    args = ap.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES) + sorted(BUILDERS)))
        return 0
    spark = SparkSession.builder.appName(f"cabgrid-{args.query}").getOrCreate()
    if args.cmd == "explain":
        QUERIES[args.query](spark, args.tables).explain("formatted")
        return 0
    if args.cmd == "batch":
        if args.tables:
            result = QUERIES[args.query](spark, args.tables)
        elif args.query not in TRIP_OPERATORS:
            ap.error(f"{args.query} runs on --tables only")
        else:
            if args.format == "text":
                raw = read_trips(spark, args.trips, args.min_partitions)
            elif args.format == "parquet":
                raw = spark.read.schema(TRIP_SCHEMA).parquet(args.trips)
            else:
                raw = read_trip_table(spark, args.trips, args.start, args.end)
            result = TRIP_OPERATORS[args.query](clean_trips(raw))
        result.write.mode("overwrite").parquet(args.out)
        return 0
    if args.kafka_servers:
        trips = read_trip_stream_kafka(spark, args.kafka_servers, args.topic)
    else:
        trips = read_trip_stream(spark, args.source, args.format, args.max_files_per_trigger)
    build, per_batch = BUILDERS[args.query]
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not (args.checkpoint or root):
        ap.error("name a --checkpoint folder, or set spark.checkpoint.dir: a restart needs it again")
    checkpoint = args.checkpoint or f"{root.rstrip('/')}/{args.query}"
    q = write_stream(build(trips), args.out, checkpoint, per_batch=per_batch, available_now=args.available_now)
    q.awaitTermination()
    return 0 if q.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
