"""Context-triggered piecewise hashes of texts, and their likeness.

A rolling hash over the last seven bytes decides where chunks end: at block
size ``2**k`` a chunk ends where the hash ends in ``k`` one bits, so an edit
moves no boundary but those near it, and the boundaries of a block size are
among those of all smaller ones. Each chunk gives one of 64 characters. A
fingerprint is ``block:signature:signature at twice the block``; the block is
the smallest one (at least 2) with at most 64 chunks. Two fingerprints are
compared at a block size that both have, by the edit distance of their
signatures (insertions and deletions; a replacement is one of each).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.scratch import small_batches

U32 = np.uint32
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
REACH = 7  # bytes under the rolling hash
LEAST_LEVEL = 1
MOST_CHUNKS = 64
#: Signatures without a common run of characters count as unlike: (shorter
#: signature's length below which, run); longer ones need LONG_RUN.
SHORT_RUNS = ((12, 2), (32, 3))
LONG_RUN = 4
SLICE_BYTES = 512 << 10
BLOCK_BYTES = 32 << 20
#: Blocks of ids at most, so that what the driver and every task hold of them is
#: bounded; a larger block is read in order by its task, not held.
MOST_BLOCKS = 1 << 14


def _levels(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose rolling hash ends in at least LEAST_LEVEL ones, and how many."""
    roll = np.zeros(len(data), dtype=U32)
    wide = data.astype(U32) + U32(1)
    factor = 1
    for k in range(min(REACH, len(data))):
        roll[k:] += wide[: len(data) - k] * U32(factor)
        factor = factor * 0x9E3779B1 % 2**32
    roll ^= roll >> U32(15)
    roll *= U32(0x85EBCA77)
    roll ^= roll >> U32(13)
    at = np.flatnonzero((roll & U32((1 << LEAST_LEVEL) - 1)) == (1 << LEAST_LEVEL) - 1)
    zero = ~roll[at]
    lowest = (zero & (~zero + U32(1))).astype(np.float64)
    return at, np.where(lowest > 0, np.log2(np.maximum(lowest, 1)), 32).astype(np.int64)


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text (an empty one: ``2::``)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offs = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at, level = _levels(data)
    of = np.searchsorted(offs, at, side="right") - 1
    near = at - offs[of] < REACH - 1  # the hash would reach into the text before
    last = at == offs[of + 1] - 1  # a text's last chunk ends there anyway
    at, level, of = (x[~(near | last)] for x in (at, level, of))
    counts = np.bincount(of * 33 + level, minlength=len(texts) * 33).reshape(-1, 33)
    at_least = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
    block = np.maximum(np.argmax(np.concatenate((at_least < MOST_CHUNKS, np.ones((len(texts), 1), bool)), axis=1), axis=1), LEAST_LEVEL)
    signatures = []
    for step in (0, 1):
        cut = level >= block[of] + step
        ends = np.sort(np.concatenate((at[cut] + 1, offs[1:][sizes > 0])))
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        codes = (tx.hash_spans(data, starts, ends) >> tx.U64(58)).astype(np.int64)
        chars = np.array(list(ALPHABET))[codes]
        pieces = np.searchsorted(starts, offs)
        signatures.append(["".join(chars[a:b]) for a, b in zip(pieces[:-1], pieces[1:])])
    return [f"{1 << int(b)}:{x}:{y}" for b, x, y in zip(block, *signatures)]


def common_length(x: str, y: str) -> int:
    """Length of the longest common subsequence, 64 characters at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for c in y:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(x) - row.bit_count()


def _alike(x: str, y: str) -> float:
    if not x or not y:
        return float(x == y)
    least = min(len(x), len(y))
    run = min(least, next((r for n, r in SHORT_RUNS if least < n), LONG_RUN))
    seen = {x[i : i + run] for i in range(len(x) - run + 1)}
    if not any(y[i : i + run] in seen for i in range(len(y) - run + 1)):
        return 0.0
    return 2 * common_length(x, y) / (len(x) + len(y))


def likeness(x: str, y: str) -> float:
    """1 for equal fingerprints, 0 for unlike ones or without a common block
    size, else 1 less the edit distance over both lengths; the better of the
    block sizes that both have."""
    if x == y:
        return 1.0
    a, a1, a2 = x.split(":")
    b, b1, b2 = y.split(":")
    a, b = int(a), int(b)
    if a == b:
        return max(_alike(a1, b1), _alike(a2, b2) if a2 and b2 else 0.0)
    if a == 2 * b:
        return _alike(a1, b2)
    if b == 2 * a:
        return _alike(a2, b1)
    return 0.0


def fingerprint_column(texts: pa.Array) -> pa.Array:
    """For ``F.arrow_udf``: the fingerprint of each text; null counts as empty."""
    return pa.array(fingerprints([(t or "").encode() for t in texts.to_pylist()]), pa.string())


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come block by block, each block's in descending id and then the
    first row of the block that follows it (``guest``)."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        raw = [(t or "") for _, _, _, t in rows]
        own = [i for i in range(len(rows) - 1) if not rows[i][1]]
        edits = []
        for i in own:
            if rows[i + 1][0] != rows[i][0]:
                raise ValueError("a block's rows aren't followed by its guest")
            m = len(raw[i]) // 3
            edits.append((raw[i][: len(raw[i]) - m] + raw[i + 1][:m]).encode())
        prints = fingerprints([t.encode() for t in raw] + edits)
        new = prints[len(raw) :]
        return pa.record_batch(
            [
                pa.array([rows[i][2] for i in own], pa.int64()),
                pa.array([len(raw[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edits], pa.string()),
                pa.array([prints[i] for i in own], pa.string()),
                pa.array(new, pa.string()),
                pa.array([likeness(prints[i], e) for i, e in zip(own, new)], pa.float64()),
                pa.array([likeness(prints[i], prints[i + 1]) for i in own], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    rows: list[tuple] = []
    for batch in batches:
        for part in tx.slices(batch, "text", SLICE_BYTES):
            rows += zip(*(part.column(c).to_pylist() for c in ("block", "guest", "id", "text")))
            yield out(rows)
            rows = rows[-1:]


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, in which the last
    floor(n / 3) of its n code points are replaced by the first as many (or all)
    of the next document in descending id order; the last document is followed
    by the first. Columns: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``
    (likeness to the edited text and to the next document).

    The ids are cut into at most MOST_BLOCKS blocks at quantiles; each block is a
    partition of its own, whose task reads it in order, with a copy of the first row
    of the block after it. A text travels once; texts of any length count whole, and
    rows that repeat are documents like others. Null texts count as empty. Rows with equal ids are
    ordered by text. Rows with a null id have no place in the order and are left
    out. A single document is its own successor; an empty table gives no rows;
    other columns are not read."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    size, least = rows.agg(F.sum(F.octet_length("text")), F.min("id")).first()
    if least is None:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    blocks = min(MOST_BLOCKS, max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES)))
    cuts = rows.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)] or [0.5], 20 * blocks)).first()[0]
    edges = np.unique(np.array([least, *cuts], dtype=np.int64))  # each block's least id

    @F.arrow_udf("int")
    def block_of(ids: pa.Array) -> pa.Array:
        return pa.array((np.searchsorted(edges, ids.to_numpy(zero_copy_only=False), side="right") - 1).astype(np.int32))

    placed = rows.select(block_of("id").alias("block"), "id", "text")
    # The first row of every block, for the block above it; the top block's goes to the lowest.
    heads = rows.select(block_of("id").alias("block"), "id").groupBy("block").agg(F.max("id").alias("id")).orderBy("block").collect()
    present = [r.block for r in heads]
    spark = docs.sparkSession
    guests = spark.createDataFrame(
        [(int(r.id), int(present[(k + 1) % len(present)])) for k, r in enumerate(heads)], "id long, host int"
    )
    copies = placed.join(F.broadcast(guests), "id").select(F.col("host").alias("block"), F.lit(True).alias("guest"), "id", "text")
    ordered = (
        placed.select("block", F.lit(False).alias("guest"), "id", "text")
        .unionByName(copies)
        .repartitionById(len(edges), "block")
        .sortWithinPartitions("block", "guest", F.desc("id"), F.desc("text"))
    )
    return ordered.mapInArrow(_edited, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
