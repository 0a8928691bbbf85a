"""Comma-separated trip lines -> typed trip rows.

Parsing never raises: a line that is empty, has too few fields or carries a
field that does not convert gets a ``reject_reason`` instead, so one bad
record neither stops a job nor silently disappears. ``try_cast`` keeps the
work inside generated JVM code (Spark 4 runs in ANSI mode, where a plain
``cast`` would fail the task).
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cabgrid.functions.grid import inside_grid
from cabgrid.schema import LINE_FIELDS, LINE_MIN_FIELDS, TRIP_COLUMNS

_TYPES = {
    "medallion": "string",
    "pickup_dt": "timestamp_ntz",
    "dropoff_dt": "timestamp_ntz",
    "trip_time": "int",
}


_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _field(parts: Column, name: str) -> Column:
    raw = F.get(parts, LINE_FIELDS[name])  # NULL past the end, never an error
    kind = _TYPES.get(name, "double")
    if kind == "timestamp_ntz":  # exactly LINE_TIMESTAMP_FORMAT, in no time zone
        return F.when(raw.rlike(_TIMESTAMP_PATTERN), raw.try_cast(kind))
    return raw if kind == "string" else raw.try_cast(kind)


def parse_trips(lines: DataFrame, line_col: str = "value", id_col: str | None = None, keep_line: bool = False) -> DataFrame:
    """Parse ``lines[line_col]`` into the trip columns plus ``reject_reason``
    (NULL for a good line, else ``empty_line``, ``too_few_fields`` or
    ``bad_field``). ``event_id`` comes from ``id_col`` when given, else it is
    a 64-bit hash of the line (equal lines are equal trips, so the hash is a
    sufficient tie-breaker). ``keep_line`` adds the text itself as ``line``.

    A line is split once and each field cast once: the fields leave a one-row
    ``inline``, below which no later filter is pushed (a filter on plain
    expressions would repeat the split for every column it names)."""
    event_id = F.col(id_col).cast("bigint") if id_col else F.xxhash64(F.col(line_col))
    split = lines.select(event_id.alias("event_id"), F.col(line_col).alias("_line"), F.split(F.col(line_col), ",", -1).alias("_parts"))
    names = [c for c in TRIP_COLUMNS if c != "event_id"]
    fields = F.struct(*[_field(F.col("_parts"), c).alias(c) for c in names])
    kept = [F.col("_line").alias("line")] if keep_line else []
    row = split.select(
        "event_id", *kept, (F.length("_line") == 0).alias("_empty"), F.size("_parts").alias("_size"), F.inline(F.array(fields)).alias(*names)
    )
    any_bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])
    reason = (
        F.when(F.col("_empty"), F.lit("empty_line"))
        .when(F.col("_size") < LINE_MIN_FIELDS, F.lit("too_few_fields"))
        .when(any_bad, F.lit("bad_field"))
    )
    return row.select(*TRIP_COLUMNS, reason.alias("reject_reason"), *(["line"] if keep_line else []))


def read_trips(
    spark: SparkSession, path: str, min_partitions: int | None = None
) -> DataFrame:
    """Read text (optionally gzip) trip files and parse them. A gzip file is
    a single split, so when there are fewer files than ``min_partitions`` the
    lines are spread round-robin before parsing."""
    lines = spark.read.text(path)
    if min_partitions and len(lines.inputFiles()) < min_partitions:
        lines = lines.repartition(min_partitions)
    return parse_trips(lines)


#: What can become of a line, in the order in which it is decided.
OUTCOMES = ("empty_line", "too_few_fields", "bad_field", "outside_grid", "accepted")


def outcome() -> Column:
    """What became of a parsed line: one of OUTCOMES."""
    inside = inside_grid("pickup_long", "pickup_lat") & inside_grid("dropoff_long", "dropoff_lat")
    return F.coalesce(F.col("reject_reason"), F.when(~inside, F.lit("outside_grid")), F.lit("accepted"))


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Number of lines per outcome: parse rejects, ``outside_grid`` (zero or
    out-of-box coordinates) and ``accepted``."""
    return parsed.groupBy(outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("num_lines"))
