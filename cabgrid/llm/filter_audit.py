"""What document filters remove, alone and after one another.

Every document gets a bitmap of the filters it fails. Four filters look at the
text alone. The fifth, duplicates, is decided by radix tries: a task first
inserts its own texts into a compressed trie whose terminals hold the least id,
so that copies within a window of texts are settled there and a text leaves the
window once. What is left is range-partitioned by text prefixes (the ranges are
cut where the prefixes of all those texts lie, a long shared prefix between its
texts' hashes), and each range's texts are inserted, in order, into tries again.
Bitmaps are then reduced to counts by part and bitmap, from which every order of
the filters is worked out without looking at a document again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.scratch import Scratch, saved, small_batches

SLICE_BYTES = 1 << 20
#: Texts that a trie holds before it is emptied.
TRIE_BYTES = 16 << 20
#: Bytes of a text that its range is chosen by.
PREFIX_BYTES = 64
#: Texts of a range, about, and the most ranges; larger ranges are sorted on disk.
RANGE_BYTES = 32 << 20
MOST_RANGES = 1 << 14
_LAST = np.iinfo(np.int64).max


class Trie:
    """A compressed trie of byte strings; a terminal holds the least id inserted."""

    class Node:
        __slots__ = ("label", "kids", "least")

        def __init__(self, label: bytes, kids: dict[int, Trie.Node], least: int | None) -> None:
            self.label, self.kids, self.least = label, kids, least

    def __init__(self) -> None:
        self.root = Trie.Node(b"", {}, None)
        self.bytes = 0

    @staticmethod
    def _shared(label: bytes, text: bytes, at: int) -> int:
        """Bytes that ``label`` has in common with ``text`` from ``at`` on."""
        low, high = 0, min(len(label), len(text) - at)
        while low < high:
            middle = (low + high + 1) // 2
            if text.startswith(label[low:middle], at + low):
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, text: bytes, id: int) -> Trie.Node:
        """The terminal of ``text``, after its least id was updated."""
        node, at = self.root, 0
        while at < len(text):
            kid = node.kids.get(text[at])
            if kid is None:
                node.kids[text[at]] = kid = Trie.Node(text[at:], {}, id)
                self.bytes += len(text) - at + 200
                return kid
            if text.startswith(kid.label, at):
                node, at = kid, at + len(kid.label)
                continue
            k = self._shared(kid.label, text, at)
            node.kids[text[at]] = middle = Trie.Node(kid.label[:k], {kid.label[k]: kid}, None)
            kid.label = kid.label[k:]
            node, at = middle, at + k
        if node.least is None or id < node.least:
            node.least = id
        return node


class Texts:
    """The texts of a slice: bytes, offsets, and counts by text."""

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        self.data, self.offs = data, offs
        raw = data.tobytes()
        self.raw = [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        words = [t.split() for t in self.raw]  # at spaces and 0x09-0x0D
        self.words = np.array([len(w) for w in words], dtype=np.int64)
        self.distinct = np.array([len(set(w)) for w in words], dtype=np.int64)

    def count(self, where: np.ndarray) -> np.ndarray:
        """Bytes of each text for which ``where`` holds."""
        total = np.concatenate([[0], np.cumsum(where)])
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def code_points(self) -> np.ndarray:
        return self.count((self.data & 0xC0) != 0x80)


def _any_of(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table


_MARKS = _any_of("#$%&*|")

#: Filters by letter: which texts of a slice fail.
FILTERS: dict[str, Callable[[Texts], np.ndarray]] = {
    "A": lambda t: t.words < 100,
    "B": lambda t: 100 * t.distinct < 80 * t.words,
    "C": lambda t: 100 * t.count((t.data - np.uint8(65)) < 26) > 10 * t.code_points(),
    "D": lambda t: t.count(_MARKS[t.data]) > 0,
}
#: The letter of the duplicate filter.
DUPLICATE = "E"

_LOCAL = "doc_id long, part string, mask int, n long, size long, text binary"
_OPEN = "doc_id long, part string, mask int, n long"


def _local(filters: dict[str, Callable[[Texts], np.ndarray]], trie_bytes: int):
    duplicate = 1 << len(filters)

    def emptied(held: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
        settled, still, texts = {}, [], []
        for (node, id, part, mask), (text, n) in held.items():
            if id > node.least:
                key = (id, part, mask | duplicate)
                settled[key] = settled.get(key, 0) + n
            else:
                still.append((id, part, mask, n))
                texts.append(text)
        rows = still + [(*k, n) for k, n in settled.items()]
        texts += [None] * len(settled)
        for i in range(0, len(rows), 4096):
            some, t = rows[i : i + 4096], texts[i : i + 4096]
            ids, parts, masks, ns = zip(*some)
            yield pa.record_batch(
                [
                    pa.array([None if x == _LAST else x for x in ids], pa.int64()),
                    pa.array(parts, pa.string()),
                    pa.array(masks, pa.int32()),
                    pa.array(ns, pa.int64()),
                    pa.array([0 if x is None else len(x) + 1 for x in t], pa.int64()),
                    pa.array(t, pa.binary()),
                ],
                names=["doc_id", "part", "mask", "n", "size", "text"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = Trie(), {}
        for batch in batches:
            for piece in tx.slices(batch, "text", SLICE_BYTES):
                texts = Texts(*tx.string_bytes(piece.column("text")))
                mask = sum((fails(texts).astype(np.int32) << i for i, fails in enumerate(filters.values())), np.zeros(len(texts.raw), np.int32))
                ids = piece.column("doc_id").fill_null(_LAST).to_pylist()
                for id, part, m, text in zip(ids, piece.column("part").to_pylist(), mask.tolist(), texts.raw):
                    node = trie.insert(text, id)
                    if id > node.least:
                        text = None
                    have = held.setdefault((node, id, part, m), [text, 0])
                    have[1] += 1
                if trie.bytes + 200 * len(held) >= trie_bytes:
                    yield from emptied(held)
                    trie, held = Trie(), {}
        yield from emptied(held)

    return run


def _in_order(duplicate: int, trie_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Trie(), None
        for batch in batches:
            mask = batch.column("mask").to_numpy(zero_copy_only=False).copy()
            keys = zip(batch.column("prefix").to_pylist(), batch.column("hash").to_pylist())
            ids = batch.column("doc_id").fill_null(_LAST).to_pylist()
            for i, (key, id, text) in enumerate(zip(keys, ids, batch.column("text"))):
                if key != last and trie.bytes >= trie_bytes:
                    trie = Trie()
                last = key
                if trie.insert(text.as_py(), id).least < id:  # equal texts come in the order of their ids
                    mask[i] |= duplicate
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), pa.array(mask, pa.int32()), batch.column("n")], names=["doc_id", "part", "mask", "n"])

    return run


def filter_masks(
    docs: DataFrame,
    filters: dict[str, Callable[[Texts], np.ndarray]] = FILTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """Documents by the filters they fail: ``doc_id``, ``part`` (null: empty),
    ``mask`` (bit i: the i-th filter; the bit after them: an equal text with a
    smaller id exists) and ``n``, how many rows that is (rows with one id, text and
    part may be counted together or not).

    Null texts are empty ones, and empty texts are equal. A null id is larger than
    all others; equal ids aren't smaller than one another. Texts of any length are
    compared whole. An empty table gives an empty result; other columns aren't read."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part")
    )
    with Scratch(spark) as keep:
        local = keep(rows.mapInArrow(_local(filters, trie_bytes), _LOCAL), "local")
        size = local.agg(F.sum("size")).first()[0] or 0
        ranges = min(MOST_RANGES, max(spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES)))
        still = local.where("text is not null").select(
            "doc_id", "part", "mask", "n", "text", F.substring("text", 1, PREFIX_BYTES).alias("prefix"), F.xxhash64("text").alias("hash")
        )
        ordered = still.repartitionByRange(ranges, "prefix", "hash").sortWithinPartitions("prefix", "hash", F.asc_nulls_last("doc_id"))
        decided = ordered.mapInArrow(_in_order(1 << len(filters), trie_bytes), _OPEN)
        return saved(decided.unionByName(local.where("text is null").drop("size", "text")), "masks")


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``mask``, ``n``, ``good`` and ``toxic``: documents, and those that
    ``labels`` calls good (quality 1) or toxic (toxic 1). An id without a label is
    neither; of several labels of an id, one is enough."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("of"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    known = known.groupBy("of").agg(F.max(F.col("good").cast("int")).alias("good"), F.max(F.col("toxic").cast("int")).alias("toxic"))
    joined = masks.join(known, F.col("doc_id") == F.col("of"), "left")
    counts = [F.sum("n").alias("n")] + [F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    return joined.groupBy("part", "mask").agg(*counts)


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """For each part, order of the filters and step: the documents ``kept`` after
    it and ``removed`` by it, ``redundant`` ones (failing its filter, but gone
    before), ``unique_fails`` (failing no other filter), ``good_lost`` and
    ``toxic_lost`` by it, and ``shapley``: its filter's removals summed over all
    orders. ``counts`` has the rows of :func:`mask_counts` (at most 2 ** filters
    for a part); bit i of a mask belongs to ``letters[i]``."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(k + 1).alias("step"),
            F.lit(bit[c]).alias("own"),
            F.lit(reduce(int.__or__, (bit[x] for x in order[:k]), 0)).alias("before"),
        )
        for order in permutations(letters)
        for k, c in enumerate(order)
    ]
    rows = counts.select("*", F.explode(F.array(*steps)).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda condition, what, name: F.sum(F.when(condition, F.col(what)).otherwise(0)).cast("long").alias(name)
    report = rows.groupBy("part", "filter_order", "step", "own").agg(
        total(~gone & ~fails, "n", "kept"),
        total(~gone & fails, "n", "removed"),
        total(gone & fails, "n", "redundant"),
        total(F.col("mask") == F.col("own"), "n", "unique_fails"),
        total(~gone & fails, "good", "good_lost"),
        total(~gone & fails, "toxic", "toxic_lost"),
    )
    return report.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of FILTERS and the duplicate filter over ``docs``, by language."""
    return audit(mask_counts(filter_masks(docs), labels), "".join(FILTERS) + DUPLICATE)
