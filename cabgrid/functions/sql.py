"""The column expressions as temporary SQL functions, for questions in SQL text."""

from pyspark.sql import SparkSession

from cabgrid.schema import (
    CELL_STEP_LAT,
    CELL_STEP_LON,
    CONGESTED_MESSAGE,
    IDLE_MESSAGE,
    LAT_MAX,
    LAT_MIN,
    LON_MAX,
    LON_MIN,
    ORIGIN_LAT,
    ORIGIN_LON,
)


def _filled(template: str, value: str) -> str:
    before, after = template.split("{}")
    return f"concat('{before}', {value}, '{after}')"


def _definitions() -> dict[str, str]:
    scaled = "CAST(floor(x * 100D + 0.5D) AS BIGINT)"
    fixed = f"concat(CAST({scaled} DIV 100 AS STRING), '.', lpad(CAST({scaled} % 100 AS STRING), 2, '0'))"
    return {
        "cab_cell(lon DOUBLE, lat DOUBLE) RETURNS STRING": (
            f"concat_ws('.', CAST(1 + floor(0.5D + (lon - {ORIGIN_LON}D) / {CELL_STEP_LON}D) AS STRING), "
            f"CAST(1 + floor(0.5D + ({ORIGIN_LAT}D - lat) / {CELL_STEP_LAT}D) AS STRING))"
        ),
        "cab_inside(lon DOUBLE, lat DOUBLE) RETURNS BOOLEAN": (
            f"lon BETWEEN {LON_MIN}D AND {LON_MAX}D AND lat BETWEEN {LAT_MIN}D AND {LAT_MAX}D"
        ),
        "cab_wrapped_minutes(seconds BIGINT) RETURNS INT": "CAST(pmod(pmod(seconds, 86400) DIV 60, 60) AS INT)",
        "cab_idle_message(x DOUBLE) RETURNS STRING": _filled(IDLE_MESSAGE, fixed),
        "cab_congested_message(cell STRING) RETURNS STRING": _filled(CONGESTED_MESSAGE, "cell"),
    }


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``cab_cell``, ``cab_inside``, ``cab_wrapped_minutes``, ``cab_idle_message``
    and ``cab_congested_message`` known to the session. They are SQL expressions, so
    queries with them are optimised, and pushed down, as if written out."""
    for head, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
