"""Repeated word sequences across documents, by recompression.

The words of every text are symbols. A *pair round* deals all symbols by their
name into left and right ones and replaces each left symbol followed by a right
one by a new symbol, whose name is a hash of the two names; a name therefore
means the same word sequence in every document, task and machine, and no round
needs a dictionary or a shuffle. After ``r`` rounds a symbol spans at most
``2**r`` words and is determined by ``2**r - 1`` words on either side, so equal
word sequences get equal interior symbols. Runs of equal names are left as they
are: two equal names never join, and a window in a run still holds a symbol.

Each window of ``window`` words is represented by the smallest name among the
symbols inside it that its own words determine; the number of rounds is the
largest for which there always is one. Consecutive windows with the same
smallest name travel together under that name: names are dealt over the
cluster, a name that occurs once is dropped, and under a shared name the
window fingerprints (64 bits beside 32 of the name and its bucket, over all words
of the window) verify which windows are repeats and which document has them first.

A frequent word with a low hash represents a share of all windows that doesn't
fall as the corpus grows. Names are therefore counted first, and the windows of
a heavy one are dealt by bits of their fingerprints too: equal windows still meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.scratch import small_batches

U64 = tx.U64
#: Text parsed at once by a task, and text whose symbols share one bucket.
SLICE_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20
#: Windows of one name from which they are spread, over parts of a quarter as many.
HEAVY_WINDOWS = 1 << 20
#: Windows that travel together, at most (their number takes one byte).
MOST_TOGETHER = 255
#: Names a task counts at once, and the least count that it reports.
COUNTED_NAMES = 1 << 18
LEAST_COUNT = 32
#: Windows of a bucket that are compared at once.
SETTLED_WINDOWS = 1 << 18


def rounds_for(window: int) -> int:
    """Pair rounds such that every window holds a symbol it determines."""
    r = 0
    while 2 * (2 ** (r + 1) - 1) + 2 * 2 ** (r + 1) - 1 <= window:
        r += 1
    return r


def pair_rounds(names: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols after so many pair rounds.
    ``first`` holds the first word of each text; symbols never cross texts."""
    start = np.arange(len(names))
    text_start = np.zeros(len(names) + 1, dtype=bool)
    text_start[first] = True
    for r in range(rounds):
        if len(names) < 2:
            break
        left = (tx.mix(names + U64(0x632BE59BD9B4E019 * (r + 1) % 2**64)) >> U64(63)).astype(bool)
        joined = left[:-1] & ~left[1:] & ~text_start[start[1:]]
        made = tx.mix(names[:-1] * U64(0x9FB21C651E98DF25) + names[1:] + U64(r))
        merged = names.copy()
        merged[:-1] = np.where(joined, made, names[:-1])
        stays = np.ones(len(names), dtype=bool)
        stays[1:] = ~joined
        names, start = merged[stays], start[stays]
    return names, start


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo..hi]) for inclusive ranges, by a sparse table."""
    size = hi - lo + 1
    out = np.empty(len(lo), dtype=values.dtype)
    level, table = 0, values
    while True:
        here = (size >= 1 << level) & (size < 2 << level)
        if here.any():
            out[here] = np.minimum(table[lo[here]], table[hi[here] + 1 - (1 << level)])
        if not (size >= 2 << level).any():
            return out
        table = np.minimum(table[: len(table) - (1 << level)], table[1 << level :])
        level += 1


def windows_of(data: np.ndarray, offs: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """For every window of every text: text number, first word (within the
    text), representing name, fingerprint."""
    starts, ends, first = tx.find_words(data, offs)
    words = tx.hash_spans(data, starts, ends)
    total = len(words)
    length = np.diff(first)
    at = np.repeat(np.arange(len(length)), length)
    inside = np.arange(total) - first[at]
    t = np.flatnonzero(inside + window <= length[at])
    if len(t) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U64), none.astype(U64)
    rounds = rounds_for(window)
    margin = 2**rounds - 1
    names, start = pair_rounds(words, first[:-1][length > 0], rounds)
    begun = np.zeros(total + 2, dtype=np.int64)  # symbols that start before word i
    begun[start + 1] = 1
    begun[total + 1] = 1
    np.cumsum(begun, out=begun)
    name = _range_min(names, begun[t + margin], begun[t + window - margin + 1] - 2)
    seen = tx.hash_long_windows(words, window, tx.WORD_BASE_2)[t]
    return at[t], inside[t], name, seen


def _repeated(name: np.ndarray, seen: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have an equal name and fingerprint with a smaller doc."""
    order = np.lexsort((seen, name))
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[order[1:]] != name[order[:-1]]) | (seen[order[1:]] != seen[order[:-1]])
    edges = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[order], edges)
    later = np.empty(len(name), dtype=bool)
    later[order] = doc[order] > np.repeat(least, np.diff(edges, append=len(name)))
    return later


def _stretches(*columns: np.ndarray, at: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the stretches with equal columns and consecutive ``at``
    (with ``most``: longer ones are cut)."""
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1] + 1
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    begin = np.flatnonzero(new)
    if most is not None:
        size = np.diff(begin, append=len(at))
        pieces = -(-size // most)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(begin, pieces) + nth * most
    return begin, np.diff(begin, append=len(at))


def _planes(x: np.ndarray) -> bytes:
    """The numbers' lowest bytes, then their next ones and so on: ids and places
    differ little in the higher bytes, which Spark's compression then takes away."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind)[:, 0]


_SENT = "bucket int, name binary, doc binary, tag binary, first binary, n binary, seen binary"
_FOUND = "doc long, tag int, starts binary"


def _slice_windows(part: pa.RecordBatch, window: int) -> tuple[np.ndarray, ...]:
    """Text number, first word, name, fingerprint and document of a slice's windows,
    and whether a smaller document of the slice has the window too."""
    ids = part.column("doc").to_numpy(zero_copy_only=False)
    at, t, name, seen = windows_of(*tx.string_bytes(part.column("text")), window)
    doc = ids[at]
    return at, t, name, seen, doc, _repeated(name, seen, doc) if len(at) else np.zeros(0, bool)


def _frequent(names: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by name, for ``most`` names at most: if there are more, the largest
    count left out is taken from all (at most 1 / most of the windows is lost to a name)."""
    names, which = np.unique(names, return_inverse=True)
    counts = np.bincount(which, weights=counts, minlength=len(names)).astype(np.int64)
    if len(names) > most:
        counts = counts - np.partition(counts, -most - 1)[-most - 1]
        names, counts = names[counts > 0], counts[counts > 0]
    return names, counts


def _count(window: int, most: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = np.zeros(0, U64), np.zeros(0, np.int64)
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                _, _, name, _, _, later = _slice_windows(part, window)
                some, n = np.unique(name[~later], return_counts=True)
                names, counts = _frequent(np.concatenate((names, some)), np.concatenate((counts, n)), most)
        often = counts >= least
        yield pa.record_batch([pa.array(names[often].view(np.int64)), pa.array(counts[often])], names=["name", "n"])

    return run


def heavy_names(rows: DataFrame, window: int, heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (ascending) with ``heavy`` windows or more, and into how many parts (a
    power of two) each one's windows go. There are fewer than windows / ``heavy``."""
    counted = rows.mapInArrow(_count(window, COUNTED_NAMES, min(LEAST_COUNT, heavy)), "name long, n long")
    found = counted.groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= heavy).collect()
    names = np.array([r.name for r in found], dtype=np.int64).view(U64)
    parts = np.array([1 << (4 * r.n // heavy - 1).bit_length() for r in found], dtype=U64)
    order = np.argsort(names)
    return names[order], parts[order]


def _dealt(name: np.ndarray, seen: np.ndarray, buckets: int, heavy: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The bucket of each window: by its name, and by its fingerprint if that is heavy."""
    to = (name % U64(buckets)).astype(np.int32)
    names, parts = heavy
    if len(names):
        place = np.minimum(np.searchsorted(names, name), len(names) - 1)
        hot = names[place] == name
        part = seen[hot] & (parts[place[hot]] - U64(1))
        to[hot] = (tx.mix(name[hot] + part * U64(0x9E3779B97F4A7C15)) % U64(buckets)).astype(np.int32)
    return to


def _send(window: int, buckets: int, heavy: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64), np.zeros(0, U64))):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("name", "doc", "tag", "first", "n", "seen")])
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                at, t, name, seen, doc, later = _slice_windows(part, window)
                if len(at) == 0:
                    continue
                tag = part.column("tag").to_numpy(zero_copy_only=False)[at]
                rows = []
                # Repeats of a smaller document in the same slice are settled here.
                begin, n = _stretches(at[later], at=t[later], most=MOST_TOGETHER)
                if len(begin):
                    x, y = doc[later][begin], tag[later][begin]
                    rows.append((int(x[0]) % buckets, b"", x, y, t[later][begin].astype(np.uint32), n.astype(np.uint8), b""))
                keep = ~later
                at, t, name, seen, doc, tag = at[keep], t[keep], name[keep], seen[keep], doc[keep], tag[keep]
                to = _dealt(name, seen, buckets, heavy)
                begin, n = _stretches(at, name, to, at=t, most=MOST_TOGETHER)
                to = to[begin]
                order = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
                for some in np.split(order, cuts[1:]):
                    if len(some) == 0:
                        continue
                    b, k = begin[some], n[some]
                    w = np.repeat(b - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
                    rows.append((int(to[some[0]]), (name[b] >> U64(32)).astype(np.uint32), doc[b], tag[b], t[b].astype(np.uint32), k.astype(np.uint8), seen[w]))
                for i in range(0, len(rows), 256):
                    cols = list(zip(*rows[i : i + 256]))
                    yield pa.record_batch(
                        [pa.array(cols[0], pa.int32())]
                        + [pa.array([v if isinstance(v, bytes) else _planes(v) for v in c], pa.binary()) for c in cols[1:]],
                        schema=schema,
                    )

    return run


def _repeats_of(name: np.ndarray, seen: np.ndarray, doc: np.ndarray, of: np.ndarray) -> np.ndarray:
    """:func:`_repeated` of windows with these fingerprints, whose entries ``of`` have
    the names and documents: equal windows meet by bits of their fingerprints, so
    that scratch memory follows a part and not the bucket."""
    parts = 1 << (len(seen) // SETTLED_WINDOWS).bit_length()
    later = np.zeros(len(seen), dtype=bool)
    for p in range(parts):
        some = np.flatnonzero((seen & U64(parts - 1)) == U64(p)) if parts > 1 else np.arange(len(seen))
        if len(some):
            later[some] = _repeated(name[of[some]], seen[some], doc[of[some]])
    return later


def _settle(table: pa.Table) -> pa.Table:
    """The windows of one bucket that a smaller document has too, by document. Of the
    fingerprints, which are most of a bucket, only those under a shared name are
    unpacked; the others stay in the table that Spark has handed over."""
    sizes_of_names = [x.as_buffer().size for x in table.column("name")]
    sent, known = ([i for i, size in enumerate(sizes_of_names) if bool(size) == s] for s in (True, False))

    def cells(c: str, kind, rows: list[int]) -> Iterator[np.ndarray]:
        column = table.column(c)
        return (_from_planes(column[i].as_buffer(), kind) for i in rows)

    def whole(c: str, kind, rows: list[int]) -> np.ndarray:
        return np.concatenate([*cells(c, kind, rows), np.zeros(0, kind)])

    docs, tags = [whole("doc", np.int64, known)], [whole("tag", np.int32, known)]
    begins, sizes = [whole("first", np.uint32, known)], [whole("n", np.uint8, known).astype(np.uint32)]
    name, n = whole("name", np.uint32, sent), whole("n", np.uint8, sent)
    order = np.argsort(name)
    same = np.zeros(len(name), dtype=bool)
    equal = name[order[1:]] == name[order[:-1]]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    del order, equal
    if same.any():
        rows = np.cumsum([0] + [sizes_of_names[i] // name.itemsize for i in sent])
        shared = [(i, slice(x, y)) for i, x, y in zip(sent, rows[:-1], rows[1:]) if same[x:y].any()]
        prints = cells("seen", U64, [i for i, _ in shared])
        seen = np.concatenate([x[np.repeat(same[at], n[at])] for x, (_, at) in zip(prints, shared)])
        doc, tag, first = (whole(c, kind, sent)[same] for c, kind in (("doc", np.int64), ("tag", np.int32), ("first", np.uint32)))
        name, n = name[same], n[same]
        of = np.repeat(np.arange(len(n), dtype=np.int32), n)
        later = np.flatnonzero(_repeats_of(name, seen, doc, of))
        of = of[later]
        at = first[of] + (later - (np.cumsum(n, dtype=np.int64) - n)[of])
        begin, size = _stretches(of, at=at)
        docs.append(doc[of[begin]])
        tags.append(tag[of[begin]])
        begins.append(at[begin].astype(np.uint32))
        sizes.append(size.astype(np.uint32))
    doc, tag, first, n = (np.concatenate(x) for x in (docs, tags, begins, sizes))
    order = np.lexsort((tag, doc))
    doc, tag, pairs = doc[order], tag[order], np.stack([first[order], n[order]], axis=1)
    cuts = np.flatnonzero((np.diff(doc, prepend=0) != 0) | (np.diff(tag, prepend=0) != 0))
    if len(doc) and (len(cuts) == 0 or cuts[0] != 0):
        cuts = np.concatenate(([0], cuts))
    return pa.table(
        {
            "doc": pa.array(doc[cuts], pa.int64()),
            "tag": pa.array(tag[cuts], pa.int32()),
            "starts": pa.array([x.tobytes() for x in np.split(pairs, cuts[1:])] if len(cuts) else [], pa.binary()),
        }
    )


def repeated_windows(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY_WINDOWS) -> DataFrame:
    """Windows of ``window`` words that also start in a document with a smaller
    id: one row per bucket and document, (``doc``, ``tag``, ``starts``), with the
    hash of the text as ``tag`` (ids may repeat) and (first word, number of
    windows) as pairs of unsigned 32-bit integers in ``starts``. The windows of a
    name with ``heavy`` of them or more are spread over several buckets."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    none = np.zeros(0, U64), np.zeros(0, U64)
    often = heavy_names(rows, window, heavy) if size >= 2 * heavy else none  # a word takes two bytes
    sent = rows.withColumn("tag", F.hash("text")).mapInArrow(_send(window, buckets, often), _SENT)
    return sent.groupBy("bucket").applyInArrow(_settle, _FOUND)


def covered_words(n_words: int, found: list[bytes], window: int) -> np.ndarray:
    """Which words of a text the repeated windows cover."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    for x in found:
        first, n = np.frombuffer(x, dtype=np.uint32).reshape(-1, 2).astype(np.int64).T
        np.add.at(change, first, 1)
        np.add.at(change, first + n + window - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _cut(window: int, layout: bool):
    def cut(text: str | None, found: list[bytes] | None) -> tuple[int, int, str]:
        raw = (text or "").encode()
        words = raw.split()
        if not found:
            return len(words), 0, (text or "") if layout else b" ".join(words).decode()
        gone = covered_words(len(words), found, window)
        if not layout:
            return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone) if not g]).decode()
        starts, _, _ = tx.find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        stays = np.ones(len(raw), dtype=bool)
        nexts = np.append(starts[1:], len(raw))
        for i in np.flatnonzero(gone):
            stays[starts[i] : nexts[i]] = False
        return len(words), int(gone.sum()), np.frombuffer(raw, np.uint8)[stays].tobytes().decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                out = [cut(t.as_py(), f.as_py()) for t, f in zip(part.column("text"), part.column("found"))]
                n, gone, kept = zip(*out)
                yield pa.record_batch(
                    [part.column("source_row"), part.column("text").is_null(), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    names=["source_row", "text_is_null", "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", layout: bool = True
) -> DataFrame:
    """Remove from every text each word covered by a window of ``window`` words
    that also starts in a document with a smaller id. All windows are judged on
    the input. Returns ``source_row`` (a struct of the other input columns),
    ``text_is_null``, ``n_words``, ``n_removed`` and ``kept_text``: with ``layout`` the text
    without the removed words and the white space after them, else the kept
    words joined by one space.

    A null text has no words and gives an empty ``kept_text``. A row with a null
    id keeps all its words and removes none elsewhere. Rows with the same id
    don't remove each other's words. Texts shorter than a window stay whole. An
    empty table gives an empty result; other columns are carried in the struct.
    """
    small_batches(docs.sparkSession)
    found = repeated_windows(docs, window, id_col, text_col).groupBy("doc", "tag").agg(F.collect_list("starts").alias("found"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("source_row"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        F.hash(F.col(text_col)).alias("h"),
    )
    joined = rows.join(found, (F.col("id") == F.col("doc")) & (F.col("h") == F.col("tag")), "left")
    joined = joined.select("source_row", "text", "found")
    schema = joined.select("source_row", F.lit(False).alias("text_is_null"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_text")).schema
    return joined.mapInArrow(_cut(window, layout), schema)
