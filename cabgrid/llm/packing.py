"""Conflict-constrained best-fit packing of documents into bins of equal size.

Documents longer than a bin are cut into whole bins and a rest. Pieces are
dealt to groups of bounded size, since bins never need pieces from all over the
corpus; each group is packed by one task, longest pieces first. Every bin
carries a bitmap of the sources and of the duplicate clusters in it. Open bins are
the leaves of a tree in the order of their residual room, whose inner nodes hold
what the bitmaps below have in common: from the tightest residual that has room,
the successor search passes over whole subtrees whose bins all conflict with the
piece, and stops at the tightest compatible bin, or else a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabgrid.llm import text as tx
from cabgrid.llm.scratch import small_batches

#: Words in a bin.
CAPACITY = 2048
#: Words dealt to one group, about; a group is one task's work.
GROUP_WORDS = 2_000_000
SLICE_BYTES = 1 << 20


@F.arrow_udf(T.LongType())
def count_words(column: pa.Array) -> pa.Array:
    """Words of each text; a null text has none."""
    parts = []
    for part in tx.slices(pa.record_batch([column], names=["text"]), "text", SLICE_BYTES):
        _, _, first = tx.find_words(*tx.string_bytes(part.column("text")))
        parts.append(np.diff(first))
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())


class _Leaf:
    """Open bins of one residual in their order, in blocks with their common bits."""

    SIZE = 64

    def __init__(self) -> None:
        self.blocks: list[list[int]] = []
        self.common: list[int] = []

    def add(self, b: int, bits: list[int]) -> None:
        if not self.blocks:
            self.blocks, self.common = [[b]], [bits[b]]
            return
        k = max(bisect_right(self.blocks, b, key=lambda block: block[0]) - 1, 0)
        insort(self.blocks[k], b)
        self.common[k] &= bits[b]
        if len(self.blocks[k]) > self.SIZE:
            half = self.blocks[k][self.SIZE // 2 :]
            del self.blocks[k][self.SIZE // 2 :]
            self.blocks.insert(k + 1, half)
            self.common[k : k + 1] = [reduce(and_, (bits[x] for x in part)) for part in self.blocks[k : k + 2]]

    def find(self, wanted: int, bits: list[int]) -> tuple[int, int] | None:
        """Block and place of the first bin that shares no bit with ``wanted``."""
        for k, common in enumerate(self.common):
            if not common & wanted:
                for i, b in enumerate(self.blocks[k]):
                    if not bits[b] & wanted:
                        return k, i
        return None

    def remove(self, k: int, i: int, bits: list[int]) -> int:
        b = self.blocks[k].pop(i)
        if self.blocks[k]:
            self.common[k] = reduce(and_, (bits[x] for x in self.blocks[k]))
        else:
            del self.blocks[k], self.common[k]
        return b


class OpenBins:
    """Bins by residual room, to be searched for the tightest compatible one.

    ``tree[1]`` is the root of a binary tree over all residuals; a node holds the
    bits that all bins below it have (-1, every bit, where there are none)."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.tree = [-1] * (2 * self.width)
        self.leaves: dict[int, _Leaf] = {}
        self.bits: list[int] = []

    def _update(self, residual: int, common: int) -> None:
        tree, at = self.tree, self.width + residual
        tree[at] = common
        while at > 1:
            at >>= 1
            now = tree[2 * at] & tree[2 * at + 1]
            if now == tree[at]:
                return
            tree[at] = now

    def put(self, residual: int, b: int) -> None:
        self.leaves.setdefault(residual, _Leaf()).add(b, self.bits)
        self._update(residual, self.tree[self.width + residual] & self.bits[b])

    def take(self, size: int, wanted: int) -> tuple[int, int] | None:
        """Remove the compatible bin with the least residual of ``size`` or more (the
        first of equal ones): (residual, bin)."""
        tree, at = self.tree, self.width + size
        while True:
            common = tree[at]
            if common >= 0 and not common & wanted:
                if at < self.width:
                    at *= 2
                    continue
                leaf = self.leaves[at - self.width]
                found = leaf.find(wanted, self.bits)
                if found is not None:
                    b = leaf.remove(*found, self.bits)
                    self._update(at - self.width, reduce(and_, leaf.common, -1))
                    return at - self.width, b
            while at & 1:  # on to the next subtree
                at >>= 1
            if at == 0:
                return None
            at += 1


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset for each piece, in the order given. ``sources`` and
    ``clusters`` are bitmaps with at most one bit (0: no constraint)."""
    shift = max((s.bit_length() for s in sources), default=0)
    bins = OpenBins(capacity)
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        wanted = source | cluster << shift
        found = bins.take(size, wanted)
        if found is None:
            found = capacity, len(bins.bits)
            bins.bits.append(0)
        residual, b = found
        out.append((b, capacity - residual))
        bins.bits[b] |= wanted
        if residual > size:
            bins.put(residual - size, b)
    return out


def _bits(values: list) -> list[int]:
    """One bit for each value that occurs twice or more; others can't conflict."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    bit: dict = {}
    return [0 if v is None or count[v] < 2 else 1 << bit.setdefault(v, len(bit)) for v in values]


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("n_words", "descending"), ("source", "ascending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("piece", "ascending")]
        )
        source, cluster = (_bits(table.column(c).to_pylist()) for c in ("source", "cluster"))
        placed = best_fit(table.column("n_words").to_pylist(), source, cluster, capacity)
        group = int(table.column("pack_group")[0].as_py())
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "piece": table.column("piece"),
                "first_word": table.column("first_word"),
                "n_words": table.column("n_words"),
                "bin": pa.array([(group << 32) + b for b, _ in placed], pa.int64()),
                "bin_offset": pa.array([o for _, o in placed], pa.int64()),
            }
        )

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    source: Column | None = None,
    cluster: Column | None = None,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Pieces of all documents and the bin of each: ``doc_id``, ``piece`` (from 0),
    ``first_word``, ``n_words``, ``bin`` and ``bin_offset`` (words before the piece
    in its bin). No bin holds more than ``capacity`` words, two pieces of one
    source or two of one cluster (default: column ``source``, and equal texts).

    Every word is in exactly one piece; texts of any length are cut, none is dropped. A null source or cluster conflicts with
    nothing. A text that is null or has no words is one piece of 0 words in no bin
    (``bin`` and ``bin_offset`` null). Rows that repeat or have a null id are
    documents like others. An empty table gives an empty result."""
    small_batches(docs.sparkSession)
    source = F.col("source").cast("string") if source is None else source.cast("string")
    cluster = F.xxhash64(F.col(text_col)) if cluster is None else cluster.cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), count_words(F.col(text_col)).alias("words"), source.alias("source"), cluster.alias("cluster")
    )
    last = F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0)).cast("int")
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.withColumn("first_word", (F.col("piece") * F.lit(capacity)).cast("long"))
    pieces = pieces.withColumn("n_words", F.least(F.col("words") - F.col("first_word"), F.lit(capacity).cast("long"))).drop("words")
    # The sum needs only the texts' words; it is a lower scan than the packing itself.
    total = rows.agg(F.sum("words")).first()[0] or 0
    groups = max(1, -(-total // group_words))
    dealt = pieces.where("n_words > 0").withColumn(
        "pack_group", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(groups)).cast("int")
    )
    packed = dealt.groupBy("pack_group").applyInArrow(
        _pack(capacity), "doc_id long, piece int, first_word long, n_words long, bin long, bin_offset long"
    )
    nothing = pieces.where("n_words = 0").select(
        "doc_id", "piece", "first_word", "n_words", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("bin_offset")
    )
    return packed.unionByName(nothing)
