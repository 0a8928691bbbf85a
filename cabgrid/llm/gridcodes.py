"""Vectors as short codes: one codebook entry for each part of a vector.

Vectors are made integers, so every sum, mean and distance is exact and no
result depends on how the rows are dealt. Each part position has its codebook,
refined by rounds over all vectors: the tasks send sums and counts by entry,
and the driver gets parts x entries x width numbers a round, whatever the size
of the table.

The nearest entry is found through a memo of grid cells. A part falls into a
coarse cell of a fixed grid; the first part seen in a cell decides for all later
ones which entries can be nearest there. The entry with the least largest
distance to the cell's box dominates every entry that is farther than it over
the whole box: one whose least distance exceeds that largest distance, or, which
is sharper, whose distance minus the other's is positive at its least over the
box. Only the entries that are left are evaluated exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cabgrid.llm.scratch import saved, small_batches

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Cells of a part's grid, at most; its memo is an array with one place for each.
MOST_CELLS = 1 << 16
#: Labels up to which their sums are sent to all tasks; more are joined by a shuffle.
SEND_LABELS = 1 << 16
#: Cells whose boxes are held against the entries at once.
CELLS_AT_ONCE = 2048


def largest(dim: int) -> int:
    """Components are held to +- this, so that a squared distance fits 63 bits."""
    return 1 << ((62 - max(dim, 1).bit_length()) // 2 - 1)


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def integers(column: pa.Array, dim: int, parts: int, scale: int) -> np.ndarray:
    """floor(scale * x) of usable vectors, with zeros up to a multiple of ``parts``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    most = largest(dim)
    whole = np.zeros((len(column), -(-dim // parts) * parts), dtype=np.int64)
    whole[:, :dim] = np.clip(np.floor(flat * scale), -most, most)
    return whole


@dataclass(frozen=True)
class Grid:
    """Cells of every component: ``inner`` has the edges between them (component,
    cells - 1), ``low`` and ``high`` what all vectors lie between."""

    inner: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def cells(self) -> int:
        return self.inner.shape[1] + 1

    @classmethod
    def of(cls, n: int, low: np.ndarray, high: np.ndarray, total: np.ndarray, squares: np.ndarray, width: int) -> Grid:
        """As many cells to a component as MOST_CELLS allows, about equally full."""
        cells = max(2, int(MOST_CELLS ** (1 / width) + 1e-9)) if 2**width <= MOST_CELLS else 1
        mean = total / n
        spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
        z = np.array([NormalDist().inv_cdf(i / cells) for i in range(1, cells)])
        edges = np.clip(np.floor(mean[:, None] + spread[:, None] * z), low[:, None], high[:, None])
        return cls(edges.astype(np.int64), low.astype(np.int64), high.astype(np.int64))


class Memo:
    """Entries that can be nearest, as a bitmap for each cell of one part's grid;
    found when a cell is first met, kept for the rest of the task."""

    def __init__(self, entries: np.ndarray, inner: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.entries, self.inner = entries, inner
        self.cells = inner.shape[1] + 1
        # The box of cell i of a component reaches from begins[i] to ends[i].
        self.begins = np.concatenate([low[:, None], inner], axis=1)
        self.ends = np.concatenate([np.maximum(inner - 1, low[:, None]), high[:, None]], axis=1)
        self.found = np.zeros(self.cells ** len(inner), dtype=np.uint64)

    def cell(self, x: np.ndarray) -> np.ndarray:
        """Number of the cell that each row lies in."""
        number = np.zeros(len(x), dtype=np.int64)
        for j, edges in enumerate(self.inner):
            number = number * self.cells + np.searchsorted(edges, x[:, j], side="right")
        return number

    def _survivors(self, cells: np.ndarray) -> np.ndarray:
        """Bitmap of the entries that aren't dominated across each cell's box. The
        rival is the entry with the smallest largest distance to the box; what its
        squared distance exceeds another's by is linear in the part, so its largest
        value over the box is that of one corner. Below 0, the rival is always nearer."""
        at = np.empty((len(cells), len(self.inner)), dtype=np.int64)
        rest = cells
        for j in range(len(self.inner) - 1, -1, -1):
            rest, at[:, j] = np.divmod(rest, self.cells)
        each = np.arange(len(self.inner))
        lo, hi = self.begins[each, at][:, None, :], self.ends[each, at][:, None, :]
        far = np.maximum(np.abs(lo - self.entries), np.abs(self.entries - hi))
        rival = (far * far).sum(axis=2).argmin(axis=1)
        slope = 2 * (self.entries[None, :, :] - self.entries[rival][:, None, :])
        norms = (self.entries * self.entries).sum(axis=1)
        excess = norms[rival][:, None] - norms + np.maximum(slope * lo, slope * hi).sum(axis=2)
        stays = excess >= 0
        return (stays.astype(np.uint64) << np.arange(len(self.entries), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row (the first of equally near ones), and its squared distance."""
        cell = self.cell(x)
        fresh = np.unique(cell[self.found[cell] == 0])
        for i in range(0, len(fresh), CELLS_AT_ONCE):
            some = fresh[i : i + CELLS_AT_ONCE]
            self.found[some] = self._survivors(some)
        open_to = self.found[cell]
        best = np.full(len(x), np.iinfo(np.int64).max)
        chosen = np.zeros(len(x), dtype=np.int64)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero((open_to >> np.uint64(k)) & np.uint64(1))
            if len(rows):
                apart = x[rows] - entry
                d = np.einsum("ij,ij->i", apart, apart)
                won = d < best[rows]
                best[rows[won]], chosen[rows[won]] = d[won], k
        return chosen, best


@dataclass(frozen=True)
class Codebooks:
    """Entries by (part, entry, position within the part), the vectors' length
    before zeros were added, and the grid."""

    entries: np.ndarray
    dim: int
    scale: int
    grid: Grid

    def memos(self) -> list[Memo]:
        w = self.entries.shape[2]
        g = self.grid
        return [Memo(e, *(a[p * w : (p + 1) * w] for a in (g.inner, g.low, g.high))) for p, e in enumerate(self.entries)]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def restored(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        chosen = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
        whole = np.concatenate([book[k] for book, k in zip(self.entries, chosen)])
        return (whole[: self.dim] / self.scale).tolist()


def _measure(dim: int, parts: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, made = 0, None
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column("vector"), dim, parts, scale)
                f = x.astype(np.float64)
                here = np.stack([f.min(axis=0), f.max(axis=0), f.sum(axis=0), (f * f).sum(axis=0)])
                n += len(x)
                made = here if made is None else np.stack([np.minimum(made[0], here[0]), np.maximum(made[1], here[1]), *(made[2:] + here[2:])])
        if made is not None:
            yield pa.record_batch([pa.array([n] * made.shape[1]), pa.array(range(made.shape[1])), *map(pa.array, made)], names=["n", "at", "low", "high", "total", "squares"])

    return run


def _sums(books: Codebooks):
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = books.memos()
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros(books.entries.shape, dtype=np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = integers(batch.column("vector"), books.dim, parts, books.scale)
            for p, memo in enumerate(memos):
                mine = x[:, p * width : (p + 1) * width]
                chosen, _ = memo.nearest(mine)
                order = np.argsort(chosen, kind="stable")
                used, begin = np.unique(chosen[order], return_index=True)
                total[p, used] += np.add.reduceat(mine[order], begin, axis=0)
                count[p, used] += np.diff(begin, append=len(order))
        p, k, j = np.nonzero(np.repeat(count[:, :, None] > 0, width, axis=2))
        yield pa.record_batch([pa.array(p), pa.array(k), pa.array(j), pa.array(total[p, k, j]), pa.array(count[p, k])], names=["part", "entry", "at", "total", "n"])

    return run


def _codes(books: Codebooks):
    parts, _, width = books.entries.shape
    digits = np.array([b"%02x" % k for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = books.memos()
        for batch in batches:
            x = integers(batch.column("vector"), books.dim, parts, books.scale)
            error = np.zeros(len(x), dtype=np.int64)
            code = np.empty((len(x), parts), dtype="S2")
            for p, memo in enumerate(memos):
                chosen, d = memo.nearest(x[:, p * width : (p + 1) * width])
                code[:, p], error = digits[chosen], error + d
            text = np.ascontiguousarray(code).view(f"S{2 * parts}")[:, 0] if len(x) else np.zeros(0, "S1")
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), pa.array([t.decode() for t in text], pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def _rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    small_batches(vectors.sparkSession)
    v = F.col(f"`{vector_col}`")
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), v.cast("array<double>").alias("vector")).where(
        usable(F.col("vector")) & (F.size("vector") > 0)
    )


def fit_codebooks(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> Codebooks | None:
    """Codebooks of all usable vectors. Each starts as that part of the vectors
    with the smallest ids (null ids last; of equal ids the smaller vector first);
    a round replaces every entry by the floor of the mean of the parts nearest to
    it. An entry that no part is nearest to stays. With fewer vectors than
    ``entries`` there are as many entries as vectors; with none the result is None.

    Vectors that are null, empty or hold null or non-finite components take no
    part. If lengths differ, the most frequent one counts (the longer one of
    equally frequent ones) and the others take no part; a length that isn't a
    multiple of ``parts`` is filled with zeros. Components beyond
    :func:`largest` are held to it. Repeated rows count as often as they occur."""
    if not 0 < entries <= 64:
        raise ValueError("a codebook has 1 to 64 entries")
    rows = _rows(vectors, id_col, vector_col, label_col)
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return None
    dim = lengths.dim
    rows = rows.where(F.size("vector") == dim).select("vec_id", "vector")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    start = integers(pa.array([r.vector for r in first], pa.list_(pa.float64())), dim, parts, scale)
    width = start.shape[1] // parts
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    vectors_only = rows.select("vector")
    seen = vectors_only.mapInArrow(_measure(dim, parts, scale), "n long, at long, low double, high double, total double, squares double")
    seen = seen.groupBy("at").agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.min, "low"), (F.max, "high"), (F.sum, "total"), (F.sum, "squares"))])
    stats = np.array([(r.low, r.high, r.total, r.squares) for r in seen.orderBy("at").collect()]).T
    grid = Grid.of(lengths["count"], *stats, width)
    for _ in range(rounds):
        sums = vectors_only.mapInArrow(_sums(Codebooks(books, dim, scale, grid)), "part long, entry long, at long, total long, n long")
        sums = sums.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in sums.collect():
            books[r.part, r.entry, r.at] = int(r.total) // r.n
    return Codebooks(books, dim, scale, grid)


def vector_codes(
    vectors: DataFrame,
    books: Codebooks | None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    send_labels: int = SEND_LABELS,
) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits for each part's entry),
    ``error`` (squared distances summed over the parts) and ``label_error`` (errors
    summed over equal labels, null labels together; null if beyond 64 bits) of
    every usable vector of the codebooks' length; other rows give none. Ids may
    repeat or be null. Without codebooks (an empty table) the result is empty."""
    spark = vectors.sparkSession
    rows = _rows(vectors, id_col, vector_col, label_col)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")).where("false")
    rows = rows.where(F.size("vector") == books.dim)
    schema = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    coded = saved(rows.mapInArrow(_codes(books), schema), "codes")
    sums = saved(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label_errors")
    few = sums.limit(send_labels + 1).count() <= send_labels
    side = sums.withColumnRenamed("label", "of_label")
    joined = coded.join(F.broadcast(side) if few else side, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error")
