"""Trip sources: the derived trip table, text lines and their parser."""

from cabgrid.sources.tables import load_table
from cabgrid.sources.trips import trips_from_events, trip_lines
from cabgrid.sources.lines import OUTCOMES, outcome, parse_trips, read_trips, reject_counts
from cabgrid.sources.store import read_trip_table, write_trip_table

__all__ = [
    "load_table",
    "trips_from_events",
    "trip_lines",
    "parse_trips",
    "read_trips",
    "reject_counts",
    "outcome",
    "OUTCOMES",
    "read_trip_table",
    "write_trip_table",
]
