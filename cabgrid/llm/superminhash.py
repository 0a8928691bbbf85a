"""Near-duplicate documents by SuperMinHash signatures.

A document's set holds the hashes of its distinct word shingles. For every
element, SuperMinHash walks a pseudo-random permutation of the signature's
components and offers the j-th of them the value ``j + r_j`` with ``r_j`` in
[0, 1): the ranks of one element are correlated (each component gets exactly
one), which lowers the variance against independent hashes. All offers of step
j are smaller than those of step j + 1, so a document stops at the first step
after which no component is empty; long documents stop after one or two.

Documents with equal sets are one class first, so copies cost one row each.
Bands of signature values give buckets. Within a bucket, signatures estimate
the similarity of all pairs, and union-find joins those that can be similar
enough into families; a very large bucket joins all its members, which may only
make a family larger. The members of a family are then checked on their full
sets, block against block, where union-find skips what is connected already:
first each block with itself and with the family's first block, which copies a
set three times on average however large the family is. Between the other blocks
only signatures travel, with the component found so far; full sets follow for the
members that may be similar to one of another component.
Only the links that join something leave a task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.components import connected
from cabgrid.llm.scratch import Scratch, saved, small_batches

U64 = tx.U64
#: 40 bands of 5 values: a pair of similarity 0.8 meets in no band with
#: probability (1 - 0.8**5)**40 < 2e-7, one of similarity 0.3 in any with 0.1.
BANDS = 40
ROWS = 5
#: Standard errors below the threshold at which an estimate still counts.
MARGIN = 5.5
#: Members up to which a bucket's pairs are estimated; rows of a task's share.
BUCKET_MEMBERS = 1024
SHARE_ROWS = 8192
#: Members of a family in one block.
BLOCK_MEMBERS = 256
SLICE_BYTES = 512 << 10
_STEP_ELEMENTS = 20_000  # elements that walk their permutations at once


def signatures(items: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` values for each set; set i is items[first[i]:first[i+1]].
    Values hold the step in the high and r in the low 40 bits. An empty set's
    values are all the largest integer."""
    out = np.full((len(first) - 1, size), np.iinfo(np.uint64).max, dtype=U64)
    at = 0
    while at < len(first) - 1:
        to = max(int(np.searchsorted(first, first[at] + _STEP_ELEMENTS, side="right")) - 1, at + 1)
        _sign(items[first[at] : first[to]], first[at : to + 1] - first[at], out[at:to])
        at = to
    return out


def _sign(items: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
    size = out.shape[1]
    flat = out.reshape(-1)
    empty = np.iinfo(np.uint64).max
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    perm: np.ndarray | None = None
    for step in range(size):
        drawn = tx.mix(items + U64((0x9E3779B97F4A7C15 * (step + 1)) % 2**64))
        swap = step + (drawn >> U64(40)).astype(np.int64) % (size - step)
        value = (drawn & U64((1 << 40) - 1)) | U64(step << 40)
        if step == 0:
            slot = swap
        else:
            if perm is None:
                perm = np.tile(np.arange(size, dtype=np.int16), (len(items), 1))
                perm[np.arange(len(items)), first_swap] = 0  # the swap of step 0
                perm[:, 0] = first_swap
            row = np.arange(len(items))
            slot = perm[row, swap]
            perm[row, swap] = perm[row, step]
            perm[row, step] = slot
        np.minimum.at(flat, of * size + slot, value)
        open_sets = (out == empty).any(axis=1)
        walk = open_sets[of]
        if not walk.any():
            return
        if step == 0:
            first_swap = swap[walk]
        elif not walk.all():
            perm = perm[walk]
        items, of = items[walk], of[walk]


def band_keys(sign: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each signature and band."""
    parts = sign[:, : bands * rows].reshape(len(sign), bands, rows)
    total = np.zeros(parts.shape[:2], dtype=U64)
    for k, p in enumerate(tx.powers(tx.WORD_BASE, rows)):
        total += tx.mix(parts[:, :, k]) * p
    return tx.mix(total + np.arange(bands, dtype=U64)[None, :])


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each
    text's begin. Fewer than ``width`` words make one shingle; none, no shingle."""
    data, offs = tx.string_bytes(column)
    data = tx.lower_ascii(data)
    starts, ends, first = tx.find_words(data, offs)
    words = tx.hash_spans(data, starts, ends)
    windows = tx.hash_windows(words, width)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            sets.append(np.unique(windows[a : b - width + 1]))
        elif b > a:
            sets.append(tx.hash_windows(words[a:b], int(b - a)) + U64(b - a))
        else:
            sets.append(words[:0])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.concatenate(([0], np.cumsum(sizes)))


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                items, first = shingle_sets(part.column("text"), width)
                sums = [np.concatenate(([0], np.cumsum(tx.mix(items + U64(k))).view(np.int64)))[first] for k in (1, 2)]
                sign = signatures(items, first, bands * rows)
                keys = band_keys(sign, bands, rows).view(np.int64)
                low = sign.astype(np.uint8)  # for estimates one byte of a value will do
                yield pa.record_batch(
                    [
                        part.column("id"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(np.diff(sums[0].view(U64)).view(np.int64), pa.int64()),
                        pa.array(np.diff(sums[1].view(U64)).view(np.int64), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1), pa.int64())),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                    ],
                    names=["id", "n", "s1", "s2", "keys", "sign"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                items, first = shingle_sets(part.column("text"), width)
                held = [items[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.record_batch([part.column("id"), pa.array(held, pa.binary())], names=["id", "held"])

    return run


def least_matches(percent: int, size: int) -> int:
    """Equal signature bytes, of ``size``, below which a pair isn't similar enough."""
    p = percent / 100
    p = p + (1 - p) / 256  # unlike values with equal bytes
    return max(1, int(size * (p - MARGIN * (p * (1 - p) / size) ** 0.5)))


class _Forest:
    """Union-find over the rows of a task; ``join`` tells whether it joined."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _alike(sign: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, least: int) -> np.ndarray:
    """(place in left, place in right) of the pairs that may be similar enough."""
    fits = 100 * np.minimum(n[left][:, None], n[right][None, :]) >= percent * np.maximum(n[left][:, None], n[right][None, :])
    found = []
    for i, a in enumerate(left):  # a row at a time: no cube of bytes
        some = np.flatnonzero(fits[i])
        near = some[(sign[right[some]] == sign[a]).sum(axis=1) >= least]
        found.append(np.stack([np.full(len(near), i), near], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _slices_of(*keys: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each group of equal keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    yield from np.split(order, np.flatnonzero(new)[1:]) if len(order) else []


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _families(percent: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        """Spanning links of the members of each bucket that may be similar."""
        key, rep, n = (table.column(c).to_numpy() for c in ("key", "rep", "n"))
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(key), -1)
        out = []
        for rows in _slices_of(key):
            rows = rows[np.argsort(rep[rows], kind="stable")]
            forest = _Forest(len(rows))
            for x, y in _alike(sign, n, rows, rows, percent, least):
                if x < y and forest.join(int(x), int(y)):
                    out.append((int(rep[rows[x]]), int(rep[rows[y]])))
        return _links(sorted(set(out)))

    return run


def _between(percent: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        """Members of two blocks that may be similar to one of another component."""
        family, first, second, rep, block, n, component = (
            table.column(c).to_numpy() for c in ("family", "first", "second", "rep", "block", "n", "component")
        )
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(rep), -1)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        pairs = _alike(sign, n, left, right, percent, least)
        a, b = left[pairs[:, 0]], right[pairs[:, 1]]
        other = component[a] != component[b]
        rows = np.unique(np.concatenate((a[other], b[other])))
        _, once = np.unique(rep[rows], return_index=True)
        rows = rows[once]
        names = ["family", "first", "second", "rep", "block", "component"]
        return pa.table([pa.array(x[rows]) for x in (family, first, second, rep, block, component)], names=names)

    return run


def _confirm(percent: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        """Links that join components of a family, for a pair of its blocks."""
        family, first, second, rep, block, component = (
            table.column(c).to_numpy() for c in ("family", "first", "second", "rep", "block", "component")
        )
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(rep), -1)
        sets = [np.frombuffer(x, dtype=U64) for x in table.column("held").to_pylist()]
        n = np.array([len(x) for x in sets])
        out = []
        for rows in _slices_of(family, first, second):
            rows = rows[np.argsort(rep[rows], kind="stable")]
            left, right = rows[block[rows] == first[rows]], rows[block[rows] == second[rows]]
            place = {int(c): k for k, c in enumerate(np.unique(component[rows]))}
            forest = _Forest(len(place))
            for x, y in _alike(sign, n, left, right, percent, least):
                a, b = left[x], right[y]
                p, q = place[int(component[a])], place[int(component[b])]
                if forest.find(p) == forest.find(q):
                    continue
                both = np.concatenate((sets[a], sets[b]))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * shared >= percent * (n[a] + n[b] - shared):
                    forest.join(p, q)
                    out.append((int(rep[a]), int(rep[b])))
        return _links(out)

    return run


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row for each row of ``docs`` with a non-null id: ``doc_id``,
    ``n_shingles`` (size of its set), ``component_id`` (smallest id reachable by
    links of 100 * intersection >= percent * union) and ``kept`` (it is its own
    component's smallest id).

    Words are lower-cased in A-Z. A text with fewer words than a shingle has its
    whole sequence as the only element; a null text or one without words has an
    empty set and no links, not even to another such text. Rows with a null id
    are left out (they can't be named). Rows that share an id share the
    component of all of them. An empty table gives an empty result; other
    columns are not read."""
    small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as keep:
        return saved(_groups(docs, shingle, percent, id_col, text_col, bands, rows, keep), "groups")


def _groups(
    docs: DataFrame,
    shingle: int,
    percent: int,
    id_col: str,
    text_col: str,
    bands: int,
    rows: int,
    keep: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    wide = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    sketch = keep(
        wide.mapInArrow(_sketch(shingle, bands, rows), "id long, n long, s1 long, s2 long, keys array<long>, sign binary"), "sketch"
    )
    full = sketch.where("n > 0")
    same = ["n", "s1", "s2"]
    classes = keep(full.groupBy(*same).agg(F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("sign").alias("sign")), "classes")
    # Every class is known by its smallest id. Buckets of one class are no use.
    members = classes.select(F.explode("keys").alias("key"), "rep", "n")
    crowded = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("least")).where("c > 1")
    left = keep(members.join(crowded, "key"), "members")
    own = full.join(classes.select(*same, "rep"), same).select("id", "n", "rep")
    # An id may come with several texts: it ties their classes together.
    ties = own.groupBy("id").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("b")).where(F.size("b") > 1)
    ties = keep(ties.select("a", F.explode("b").alias("b")).where("a <> b"), "ties")

    least = least_matches(percent, bands * rows)
    signs = classes.select("rep", "n", "sign")
    small = left.where(F.col("c") <= BUCKET_MEMBERS)
    shares = max(1, -(-small.count() // SHARE_ROWS))
    near = (
        small.join(signs, ["rep", "n"])
        .withColumn("share", F.pmod(F.xxhash64("key"), F.lit(shares)).cast("int"))
        .select("share", "key", "rep", "n", "sign")
        .groupBy("share")
        .applyInArrow(_families(percent, least), "a long, b long")
    )
    whole = left.where((F.col("c") > BUCKET_MEMBERS) & (F.col("rep") > F.col("least"))).select(F.col("least").alias("a"), F.col("rep").alias("b"))
    families = connected(near.unionByName(whole).unionByName(ties), keep).withColumnRenamed("node", "rep").withColumnRenamed("component", "family")

    # Blocks of a family; each block meets itself and the family's first block.
    sizes = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("blocks"))
    placed = keep(families.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "families")

    def sets_of(members: DataFrame) -> DataFrame:
        held = wide.join(members.select(F.col("rep").alias("id")), "id", "left_semi").mapInArrow(_sets(shingle), "id long, held binary")
        return members.join(held.withColumnRenamed("id", "rep"), "rep").join(signs.select("rep", "sign"), "rep")

    def met(members: DataFrame, others: Column) -> DataFrame:
        rows = members.withColumn("other", F.explode(others))
        return rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")

    near_blocks = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0), F.col("block")))
    # Families of one block share tasks; a pair of blocks is a task's group.
    few = max(1, -(-placed.count() // BLOCK_MEMBERS))
    pair = F.struct(F.col("family").alias("f"), F.col("first").alias("i"), F.col("second").alias("j"))
    shared = F.struct(F.pmod(F.xxhash64("family"), F.lit(few)).alias("f"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    spread = met(sets_of(placed.withColumn("component", F.col("rep"))), near_blocks)
    spread = spread.withColumn("of", F.when(F.col("blocks") == 1, shared).otherwise(pair)).drop("blocks")
    found = spread.groupBy("of").applyInArrow(_confirm(percent, least), "a long, b long")
    links = keep(found.unionByName(ties), "links")
    group = connected(links, keep).withColumnRenamed("node", "rep")

    # The other pairs of blocks: signatures first, full sets for what may join.
    far = placed.where("block > 0 and blocks > 2")
    if not far.isEmpty():
        far = far.join(group, "rep", "left").withColumn("component", F.coalesce("component", "rep")).join(signs, "rep")
        far_blocks = F.filter(F.sequence(F.lit(1), F.col("blocks") - 1), lambda b: b != F.col("block"))
        survivors = met(far, far_blocks).withColumn("of", pair).drop("blocks").groupBy("of")
        shape = "family long, first int, second int, rep long, block int, component long"
        survivors = keep(survivors.applyInArrow(_between(percent, least), shape), "survivors")
        more = sets_of(survivors).withColumn("of", pair).groupBy("of").applyInArrow(_confirm(percent, least), "a long, b long")
        links = keep(more.unionByName(links), "links")
        group = connected(links, keep).withColumnRenamed("node", "rep")
    named = own.join(group, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
    alone = sketch.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return named.unionByName(alone).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, without those that are near duplicates of a
    row with a smaller id; of rows with one id, one stays. Rows with a null id stay."""
    groups = near_duplicates(docs, shingle, percent, id_col, text_col)
    kept = groups.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    wanted = docs[id_col].cast("long") == kept["kept_id"]
    rows = docs.join(kept.hint("merge"), wanted, "left_semi")  # grows with the corpus: not sent to all tasks
    if not groups.groupBy("doc_id").count().where("count > 1").isEmpty():
        packed = rows.select(F.struct("*").alias("row"))
        order = Window.partitionBy(F.col("row").getField(id_col)).orderBy(F.xxhash64(F.col("row").getField(text_col)))
        rows = packed.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
    return rows.unionByName(docs.where(F.col(id_col).isNull()))
