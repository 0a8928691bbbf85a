"""Shards of near equal size by minimax contiguous partition.

Documents with equal texts form one atomic group. The groups are ordered by the
hash of their text, and the smallest shard capacity is searched for which a
greedy pass (fill a shard while the next group fits) needs no more shards than
there are. No contiguous partition of that order has a smaller largest shard.
The order is cut where the greedy pass at that capacity ends its shards.

Everything is DataFrame operations. Sizes before each group are sums within
4,096 fixed ranges of the hash plus the sums of the ranges before. A greedy step
is a maximum over all groups, so many capacities are tried in one pass over the
group table and a round of passes divides the search interval by their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.llm.scratch import saved

#: Capacities tried in one round of passes.
TRIES = 64
#: Parts into which the rows of one group are numbered, so a hot text isn't one task's.
PARTS = 1024


def _cuts(groups: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity, where the greedy pass ends its first shards (sizes up to
    and with the last group); fewer than asked for when all groups are placed."""
    ends: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards):
        row = groups.agg(
            *[F.max(F.when(F.col("upto") <= start + size, F.col("upto"))).alias(f"c{i}") for i, (start, size) in enumerate(zip(at, capacities))]
        ).first()
        for i, end in enumerate(row):
            if end is not None and end > at[i]:
                ends[i].append(end)
                at[i] = end
    return ends


def smallest_capacity(groups: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The least capacity for which ``shards`` greedy shards hold all groups
    (``upto``: size up to and with a group), and where they end."""
    low = max(largest, -(-total // shards))  # nothing less can do
    high = max(low, -(-total // shards) + largest)  # always enough
    best: tuple[int, list[int]] | None = None
    while True:
        span = high - low
        tries = sorted({low + span * i // (TRIES - 1) for i in range(TRIES)}) if span >= TRIES else list(range(low, high + 1))
        ends = _cuts(groups, tries, shards)
        good = next(i for i, e in enumerate(ends) if e and e[-1] == total)
        best = (tries[good], ends[good])
        if good == 0 or tries[good] - tries[good - 1] <= 1:
            return best
        low, high = tries[good - 1] + 1, tries[good]


def balanced_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus 1; null: none plus 1),
    ``text_crc32`` (null counts as empty), ``shard`` (0 to shards - 1) and ``slot``
    (0, 1, ... within each shard) for every row.

    Rows with equal texts are in one shard (a null text equals an empty one), so a
    shard exceeds the mean size by less than the largest group. Rows that repeat an
    id, or have a null one, are placed like others. With few groups,
    or a group of more than a shard's share (the others are then filled up to its
    size), the last shards stay empty; an empty table gives an empty result. Other columns are not
    read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("text_key"),
    ).withColumn("part", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(PARTS)).cast("int"))
    rows = saved(rows, "sizes")
    parts = saved(rows.groupBy("text_key", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "parts")
    groups = parts.groupBy("text_key").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    ranged = groups.withColumn("range", F.substring("text_key", 1, 3))
    ranges = ranged.groupBy("range").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most 4,096 rows
    ranges = ranges.select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before")
    )
    so_far = Window.partitionBy("range").orderBy("text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = saved(
        ranged.join(F.broadcast(ranges), "range").select(
            "text_key",
            "bytes",
            (F.col("bytes_before") + F.sum("bytes").over(so_far)).alias("upto"),
            (F.col("rows_before") + F.sum("n").over(so_far) - F.col("n")).alias("first_row"),
        ),
        "groups",
    )
    total, largest = groups.agg(F.max("upto"), F.max("bytes")).first()
    ends = smallest_capacity(groups, total, largest, shards)[1] if total else []
    shard = F.lit(0)
    for end in ends[:-1]:
        shard = shard + (F.col("upto") > end).cast("int")
    placed = groups.withColumn("shard", shard.cast("int"))
    starts = placed.groupBy("shard").agg(F.min("first_row").alias("start"))  # a row for each shard
    placed = placed.join(F.broadcast(starts), "shard").select("text_key", "shard", (F.col("first_row") - F.col("start")).alias("slot_group"))
    earlier = Window.partitionBy("text_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most PARTS rows
    offsets = parts.select("text_key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_part")).join(placed, "text_key")
    inside = Window.partitionBy("text_key", "part").orderBy("doc_id", "size")
    numbered = rows.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["text_key", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot_group") + F.col("slot_part") + F.col("within")).alias("slot")
    )
