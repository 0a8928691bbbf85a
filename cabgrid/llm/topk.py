"""Exact nearest vectors by inner product, with multi-resolution segment bounds.

A vector is cut into segments; of each the mean and the deviation are kept. For
a segment of length m, a . b <= m * (mean_a * mean_b + dev_a * dev_b), with
equality for whole proportional segments, so the sums of these terms bound the
inner product from above (and the squared distance from below, the norms being
known). Bounds get tighter with the number of segments. Candidates are bounded
coarse to fine against the tenth best score so far of each query; the exact
scores are computed for what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cabgrid.llm.scratch import saved

#: Segments of the successive bounds.
RESOLUTIONS = (1, 4, 16)
#: Rows in a block of candidates and of queries; query bytes sent at once.
BLOCK_ROWS = 2048
QUERY_BLOCK = 256
SEND_BYTES = 16 << 20
EXACT = float(1 << 53)


def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers and integer vectors floor(scale * x) of the usable rows: not
    null, and no null or non-finite component. Exact in float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    if not column.null_count and len(sizes) and (sizes == sizes[0]).all() and sizes[0] and not column.flatten().null_count:
        flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(sizes), -1)
        at = np.flatnonzero(np.isfinite(flat).all(axis=1))
        return at, list(np.floor(scale * flat[at]))
    kept, vectors = [], []
    for i, v in enumerate(column):
        if not v.is_valid:
            continue
        x = v.values
        if x.null_count:
            continue
        x = np.asarray(x.to_numpy(zero_copy_only=False), dtype=np.float64)
        if np.isfinite(x).all():
            kept.append(i)
            vectors.append(np.floor(scale * x))
    return np.array(kept, dtype=np.int64), vectors


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Vectors of one length; shorter ones are filled with zeros."""
    out = np.zeros((len(raw), width))
    for i, r in enumerate(raw):
        v = np.frombuffer(r, dtype=np.float64)
        out[i, : len(v)] = v
    return out


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of all segments, times the root of the length: the
    inner product of two such rows bounds that of the vectors."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    edges = np.unique(edges)
    if len(edges) < 2:
        return np.zeros((len(x), 1))
    size = np.diff(edges).astype(float)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    square = np.add.reduceat((x - np.repeat(mean, size.astype(int), axis=1)) ** 2, edges[:-1], axis=1)
    return np.concatenate((mean * np.sqrt(size), np.sqrt(square)), axis=1)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products as Python-exact objects only where needed."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in q], dtype=object) @ np.array([[int(v) for v in r] for r in x], dtype=object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


class _Best:
    """The k best (score, id) of each query so far: high scores, then low ids."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = [np.zeros(0, np.int64)] * queries
        self.id = [np.zeros(0, np.int64)] * queries
        self.least = np.full(queries, -np.inf)

    def offer(self, q: int, score: np.ndarray, ident: np.ndarray) -> None:
        score, ident = np.concatenate((self.score[q], score)), np.concatenate((self.id[q], ident))
        order = np.lexsort((ident, ~score))  # ~score falls as score rises, without overflow
        _, once = np.unique(ident[order], return_index=True)
        order = order[np.sort(once)][: self.k]
        self.score[q], self.id[q] = score[order], ident[order]
        if len(order) == self.k:
            self.least[q] = self.score[q][-1]


def _search(best: _Best, qid: np.ndarray, q: np.ndarray, ident: np.ndarray, x: np.ndarray) -> None:
    """Offer the block's candidates that can be among the best of each query."""
    alive = np.ones((len(q), len(x)), dtype=bool)
    floor = best.least
    if np.isfinite(floor).any():
        for segments in RESOLUTIONS:
            some_q, some_x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if len(some_q) == 0:
                return
            if segments >= x.shape[1]:
                break
            bound = segment_statistics(q[some_q], segments) @ segment_statistics(x[some_x], segments).T
            slack = 1e-9 * (1 + np.abs(bound)) + 1e-6
            # A product as large as the tenth best may still win by its smaller id.
            alive[np.ix_(some_q, some_x)] &= bound + slack >= floor[some_q, None]
    some_q, some_x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if len(some_q) == 0:
        return
    scores = _exact(q[some_q], x[some_x])
    for i, k in enumerate(some_q):
        use = alive[k, some_x] & (scores[i] >= best.least[k]) & (ident[some_x] != qid[k])
        if use.any():
            best.offer(int(k), scores[i][use], ident[some_x][use])


def _blocks(id_col: str, vector_col: str, scale: int, rows: int):
    """Pack usable rows of a task into blocks: ids, vectors end to end, width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            width = max(len(v) for v in held)
            packed = _matrix([v.tobytes() for v in held], width)
            return pa.record_batch(
                [pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([packed.tobytes()], pa.binary()), pa.array([width], pa.int32())],
                names=["ids", "vectors", "width"],
            )

        for batch in batches:
            at, vectors = quantised(batch.column(vector_col), scale)
            known = batch.column(id_col).to_numpy(zero_copy_only=False)
            for i, v in zip(at, vectors):
                ids.append(known[i])
                held.append(v)
                if len(ids) == rows:
                    yield block()
                    ids, held = [], []
        if ids:
            yield block()

    return run


def _unpack(ids: bytes, vectors: bytes, width: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    ident = np.frombuffer(ids, dtype=np.int64)
    x = np.frombuffer(vectors, dtype=np.float64).reshape(len(ident), width)
    return ident, np.pad(x, ((0, 0), (0, to - width))) if to > width else x


def _task_best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row pairs a block of candidates with a block of queries."""
        place: dict[bytes, int] = {}
        queries: list[np.ndarray] = []
        best: dict[int, _Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                width = max(r["width"], r["q_width"])
                ident, x = _unpack(r["ids"], r["vectors"], r["width"], width)
                qid, q = _unpack(r["q_ids"], r["q_vectors"], r["q_width"], width)
                n = place.setdefault(r["q_ids"], len(place))
                if n == len(queries):
                    queries.append(qid)
                    best[n] = _Best(len(qid), k)
                _search(best[n], qid, q, ident, x)
        for n, qid in enumerate(queries):
            got = best[n]
            size = [len(s) for s in got.id]
            yield pa.record_batch(
                [pa.array(np.repeat(qid, size)), pa.array(np.concatenate(got.id)), pa.array(np.concatenate(got.score))],
                names=["query_id", "vec_id", "score"],
            )

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest integer inner product with
    each query, over components floor(scale * x): ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score``. Ties go to the smaller id; a row with the query's own id
    is no candidate for it; with fewer candidates all are returned.

    Vectors that are null or hold null or non-finite components take no part, nor
    do rows with a null id. Of vectors of unlike length the shorter counts as
    filled with zeros. Scores beyond 64 bits are clipped. An id that repeats, as a
    query or a candidate, counts once, with its best score. Empty tables give an
    empty result; other columns are not read.

    The query set meets all rows in blocks. Queries of at most SEND_BYTES are sent
    to the tasks at a time; each task keeps its best rows of each query as a
    threshold for later blocks, and only those are shuffled."""

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")

    schema = "ids binary, vectors binary, width int"
    asked = saved(usable(queries).mapInArrow(_blocks("id", "v", scale, QUERY_BLOCK), schema), "queries").toDF("q_ids", "q_vectors", "q_width")
    size = asked.agg(F.sum(F.octet_length("q_vectors"))).first()[0] or 0
    turns = max(1, -(-size // SEND_BYTES))
    rows = usable(vectors).mapInArrow(_blocks("id", "v", scale, BLOCK_ROWS), schema)
    if turns > 1:
        rows = saved(rows, "blocks")
    found = None
    for turn in range(turns):
        some = asked.where(F.pmod(F.xxhash64("q_ids"), F.lit(turns)) == turn) if turns > 1 else asked
        part = rows.crossJoin(F.broadcast(some)).mapInArrow(_task_best(k), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
