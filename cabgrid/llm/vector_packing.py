"""Training sequences under several limits at once, by vector bin packing.

An example is a row's ids and an end id; the ids of its prompt, if it has one,
bear no loss. A sequence may hold so many ids, so many pieces (segments) and so
many loss-bearing ids. Sequences are filled one after another: of the pieces
that fit, the one whose demands have the largest dot product with what is left
of the limits comes next, so a sequence with much room for loss and little for
segments gets long answers, not many short ones.

Examples may be cut anywhere. One that is too long gives pieces of the largest
size; where nothing fits any more, a piece is cut to fill the room exactly; and a
sequence that must stay short (nothing is left, or no segment is free) is cut
down to a power of two, a length that needs no padding.

Each task packs the rows it reads, a window of bounded size after another; what
doesn't fill a sequence goes on to the next window. No text or id is shuffled,
whatever the keys are, and a lost task packs the same rows again.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.byte_bpe import encoder
from cabgrid.llm.scratch import small_batches

#: The id after each example's last one.
END_ID = 1
SLICE_BYTES = 512 << 10
#: Ids that a task gathers before it packs, and the share of them that it leaves for the next window.
WINDOW_IDS = 1 << 21
CARRIED = 1 / 8


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold: ids, pieces, and ids that bear loss."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Example:
    """A row's ids; ``borne`` counts the loss-bearing ids before each place (None: all bear loss)."""

    __slots__ = ("id", "ids", "borne")

    def __init__(self, id: int | None, ids: np.ndarray, prompt: int = 0) -> None:
        self.id, self.ids = id, ids
        self.borne = np.maximum(np.arange(len(ids) + 1) - prompt, 0) if prompt else None

    def loss(self, start: int, length: int) -> int:
        return length if self.borne is None else int(self.borne[start + length] - self.borne[start])

    def reach(self, start: int, tokens: int, loss: int) -> int:
        """Length of the longest piece from ``start`` within so many ids and loss-bearing ids."""
        most = min(len(self.ids) - start, tokens)
        if self.borne is None:
            return min(most, loss)
        return min(most, int(np.searchsorted(self.borne, self.borne[start] + loss, side="right")) - 1 - start)


Piece = tuple[Example, int, int]  # example, first id, number of ids


class Pool:
    """Pieces to be packed, by their demands (ids, loss-bearing ids)."""

    def __init__(self) -> None:
        self.kinds: dict[tuple[int, int], int] = {}
        self.pieces: list[deque[Piece]] = []
        self.tokens, self.loss, self.count = (np.zeros(256, dtype=np.int64) for _ in range(3))
        self.total = 0

    def add(self, piece: Piece) -> None:
        example, start, length = piece
        demand = length, example.loss(start, length)
        k = self.kinds.setdefault(demand, len(self.pieces))
        if k == len(self.pieces):
            if k == len(self.tokens):
                self.tokens, self.loss, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.tokens, self.loss, self.count))
            self.pieces.append(deque())
            self.tokens[k], self.loss[k] = demand
        self.pieces[k].append(piece)
        self.count[k] += 1
        self.total += length

    def add_cut(self, example: Example, start: int, limits: Limits) -> None:
        """The rest of an example, in pieces that a sequence may hold."""
        while start < len(example.ids):
            length = example.reach(start, limits.tokens, limits.loss)
            self.add((example, start, length))
            start += length

    def take(self, k: int) -> Piece:
        self.count[k] -= 1
        piece = self.pieces[k].popleft()
        self.total -= piece[2]
        return piece

    def best(self, room: tuple[int, int, int], limits: Limits) -> int | None:
        """The kind of the fitting piece with the largest dot product of its demands
        and the room left, both as shares of the limits; the first of equal ones."""
        n = len(self.pieces)
        tokens, loss = self.tokens[:n], self.loss[:n]
        fits = (self.count[:n] > 0) & (tokens <= room[0]) & (loss <= room[2])
        if room[1] < 1 or not fits.any():
            return None
        score = tokens * (room[0] / limits.tokens**2) + loss * (room[2] / limits.loss**2) + room[1] / limits.segments**2
        return int(np.argmax(np.where(fits, score, -1)))

    def longest(self) -> int | None:
        n = len(self.pieces)
        left = np.where(self.count[:n] > 0, self.tokens[:n], 0)
        return int(np.argmax(left)) if n and left.any() else None


def _filled(pool: Pool, limits: Limits) -> list[Piece]:
    """The pieces of the next sequence, taken from the pool."""
    room = limits.tokens, limits.segments, limits.loss
    chosen: list[Piece] = []
    while room[0] and room[1]:
        k = pool.best(room, limits)
        if k is None:
            k = pool.longest()
            if k is None:
                break
            example, start, length = pool.take(k)
            part = min(example.reach(start, room[0], room[2]), length)
            if part == 0:  # no loss-bearing id is allowed any more
                pool.add((example, start, length))
                break
            pool.add((example, start + part, length - part))
            piece = example, start, part
        else:
            piece = pool.take(k)
        chosen.append(piece)
        room = room[0] - piece[2], room[1] - 1, room[2] - piece[0].loss(*piece[1:])
    return chosen


def sequences(pool: Pool, limits: Limits, leave: int = 0) -> Iterator[list[Piece]]:
    """Sequences until at most ``leave`` ids are left in the pool."""
    while pool.total > leave:
        chosen = _filled(pool, limits)
        n = sum(p[2] for p in chosen)
        if n < limits.tokens:
            excess = n - (1 << (n.bit_length() - 1))
            while excess:
                example, start, length = chosen.pop()
                back = min(excess, length)
                pool.add((example, start + length - back, back))
                if back < length:
                    chosen.append((example, start, length - back))
                excess -= back
        yield chosen


def examples_of(data: bytes, texts: list[str], prompts: list[str] | None, ids: list, end: int) -> list[Example]:
    """One example for each text; null texts and prompts are empty."""
    encode = lambda some: encoder(data)([t or "" for t in some])
    before = encode(prompts) if prompts is not None else [b""] * len(texts)
    last = end.to_bytes(4, "little")
    return [Example(id, np.frombuffer(p + t + last, dtype="<u4"), len(p) // 4) for id, p, t in zip(ids, before, encode(texts))]


_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]


def _pack(data: bytes, limits: Limits, end: int, prompted: bool, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, made = Pool(), TaskContext.get().partitionId() << 33

        def packed(leave: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows = []
            for chosen in sequences(pool, limits, leave):
                offset = 0
                for example, start, length in chosen:
                    crc = zlib.crc32(example.ids[start : start + length].tobytes())
                    rows.append((example.id, start, length, crc, len(example.ids), example.loss(start, length), made, offset))
                    offset += length
                made += 1
            if rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=_NAMES)

        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                prompts = part.column("prompt").to_pylist() if prompted else None
                for example in examples_of(data, part.column("text").to_pylist(), prompts, part.column("doc_id").to_pylist(), end):
                    pool.add_cut(example, 0, limits)
                if pool.total >= window:
                    yield from packed(int(window * CARRIED))
        yield from packed(0)

    return run


def pack_examples(
    docs: DataFrame,
    tokenizer: bytes,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end: int = END_ID,
    window: int = WINDOW_IDS,
) -> DataFrame:
    """Pieces of all examples and the sequence of each: ``doc_id``, ``start`` (ids
    of its example before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian 32-bit integers), ``doc_tokens`` (the example's ids),
    ``loss_tokens``, ``sequence_id`` and ``offset`` (ids before it in the sequence).

    An example is the ids of its prompt, which bear no loss, and of its text, with
    ``end`` after them; without ``prompt_col`` all ids bear loss. Every id is in one
    piece and no sequence exceeds a limit; a sequence of less than ``limits.tokens``
    ids holds a power of two of them. Sequence ids are unique, not consecutive.

    Null texts and prompts are empty: an example of the end id alone. Rows that
    repeat or have a null id are examples like others. Texts of any length are
    encoded whole. An empty table gives an empty result; other columns aren't read.
    Which pieces share a sequence depends on how the rows lie in the input's
    partitions."""
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits are 1 or more")
    small_batches(docs.sparkSession)
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if prompt_col is not None:
        columns.append(F.col(f"`{prompt_col}`").cast("string").alias("prompt"))
    return docs.select(*columns).mapInArrow(_pack(tokenizer, limits, end, prompt_col is not None, window), _OUT)
