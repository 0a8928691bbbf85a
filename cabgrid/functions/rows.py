"""Emit several keyed rows per input row (one Generate, inside codegen)."""

from pyspark.sql import Column, functions as F


def keyed_rows(names: list[str], *rows: list[Column]) -> Column:
    """``inline`` of an array of structs with the given field names: every
    input row becomes ``len(rows)`` output rows. Used to feed several keys of
    one record into a single grouped aggregation instead of joining separate
    aggregations."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, r)]) for r in rows]))
