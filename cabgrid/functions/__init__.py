"""Column-level building blocks (all JVM-side Spark expressions)."""

from cabgrid.functions.grid import grid_x, grid_y, grid_cell, inside_grid
from cabgrid.functions.timecols import (
    trunc_to_second,
    seconds_between,
    wrapped_minutes,
)
from cabgrid.functions.money import avg_of_cents, sum_of_cents, to_cents
from cabgrid.functions.rows import keyed_rows
from cabgrid.functions.sql import register_sql_functions
from cabgrid.functions.text import fixed_decimal_text, idle_message, congested_message

__all__ = [
    "grid_x",
    "grid_y",
    "grid_cell",
    "inside_grid",
    "trunc_to_second",
    "seconds_between",
    "wrapped_minutes",
    "avg_of_cents",
    "sum_of_cents",
    "to_cents",
    "keyed_rows",
    "register_sql_functions",
    "fixed_decimal_text",
    "idle_message",
    "congested_message",
]
