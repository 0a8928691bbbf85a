"""Ordered neighbours (lag / lead) inside groups, without putting a group in
one task.

A plain window by group sends every row of a group to one task. Here a group is
cut into blocks by a coarse function of the ordering (a day or an hour of the
time), and ``lag`` / ``lead`` run inside (group, block). What is missing at a
block's edges comes from a table with one row per block, its first and last few
rows: a window over that table hands each block the last rows before it and the
first rows after it. That window sees a group's blocks, not its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def lag_name(col: str, j: int) -> str:
    return f"{col}_lag{j}"


def lead_name(col: str, j: int) -> str:
    return f"{col}_lead{j}"


def with_neighbors(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: list[str],
    block: Column,
    lags: int = 1,
    leads: int = 0,
) -> DataFrame:
    """Add ``{v}_lag{j}`` (j = 1..lags) and ``{v}_lead{j}`` (j = 1..leads) for
    every column ``v`` in ``values``: the value ``j`` rows before / after in
    ``order`` within the same ``by`` group, NULL past the group's ends. Same
    result as ``lag``/``lead`` over ``Window.partitionBy(by).orderBy(order)``
    (``order`` must be unique in a group, as there).

    ``block`` never falls as ``order`` rises (``to_date`` of a leading time,
    say) and bounds what one task holds: the rows of a group in one block."""
    m = max(lags, leads)
    if m < 1:
        raise ValueError("need at least one lag or lead")
    own = df.columns
    w = Window.partitionBy(*by, "_block").orderBy(*order)
    row = F.col("_row")
    others = [c for c in own if c not in values or c in (*by, *order)]
    packed = df.select(*others, block.alias("_block"), F.struct(*[F.col(v) for v in values]).alias("_row"))
    inside = packed.select(
        *others,
        "_block",
        "_row",
        F.row_number().over(w).alias("_first"),
        F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"),
        *[F.lag(row, j).over(w).alias(f"_lag{j}") for j in range(1, m + 1)],
        *[F.lead(row, j).over(w).alias(f"_lead{j}") for j in range(1, m + 1)],
    )
    # One row per block: its first rows in order, its last rows backwards.
    near = lambda kind: F.filter(F.array(row, *[F.col(f"_{kind}{j}") for j in range(1, m)]), lambda x: x.isNotNull())
    edges = inside.where((F.col("_first") == 1) | (F.col("_first") == F.col("_n")))
    # With whole rows in the aggregate, this side reads the columns of the other one,
    # and Spark shuffles the rows once for both.
    whole = F.struct(row.alias("row"), *[F.col(c) for c in others])
    edge = lambda at, rows: F.first(F.when(at, F.struct(rows.alias("rows"), whole)), ignorenulls=True).getField("rows")
    blocks = edges.groupBy(*by, "_block").agg(
        edge(F.col("_first") == 1, near("lead")).alias("_head"),
        edge(F.col("_first") == F.col("_n"), near("lag")).alias("_tail"),
    )
    # Every block has a row, so the m blocks beside one hold what it can need.
    beside = Window.partitionBy(*by).orderBy("_block")
    before = F.reverse(F.collect_list("_tail").over(beside.rowsBetween(-m, -1)))
    after = F.collect_list("_head").over(beside.rowsBetween(1, m))
    carried = blocks.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate([*by, "_block"])],
        F.flatten(before).alias("_before"),
        F.flatten(after).alias("_after"),
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate([*by, "_block"])])
    joined = inside.join(carried, same, "left")
    out = [F.col(c) if c in others else row.getField(c).alias(c) for c in own]
    for j in range(1, lags + 1):
        # Rows before this one in its block: _first - 1; the rest is carried.
        past = F.when(F.col("_first") > j, F.col(f"_lag{j}")).otherwise(F.get("_before", j - F.col("_first")))
        out += [past.getField(v).alias(lag_name(v, j)) for v in values]
    for j in range(1, leads + 1):
        left = F.col("_n") - F.col("_first")
        coming = F.when(left >= j, F.col(f"_lead{j}")).otherwise(F.get("_after", (j - 1 - left).cast("int")))
        out += [coming.getField(v).alias(lead_name(v, j)) for v in values]
    return joined.select(*out)
