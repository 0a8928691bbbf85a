"""Named query plans over a table directory, and their SQL oracles."""

from cabgrid.plans.catalog import QUERIES, TRIP_OPERATORS, derived_trips, raw_trip_table
from cabgrid.plans.oracle import ORACLE_SQL, STREAM_ORACLE_SQL
from cabgrid.plans.streaming_queries import BUILDERS, STREAM_QUERIES, trip_stream

ALL_QUERIES = {**QUERIES, **STREAM_QUERIES}
ALL_ORACLE_SQL = {**ORACLE_SQL, **STREAM_ORACLE_SQL}

__all__ = [
    "QUERIES",
    "TRIP_OPERATORS",
    "STREAM_QUERIES",
    "ALL_QUERIES",
    "ORACLE_SQL",
    "STREAM_ORACLE_SQL",
    "ALL_ORACLE_SQL",
    "derived_trips",
    "raw_trip_table",
    "BUILDERS",
    "trip_stream",
]
