"""Codes equal those of evaluating every entry for every part."""

import hashlib
import random

import numpy as np
import pytest

from cabgrid.llm import gridcodes
from cabgrid.llm.gridcodes import Codebooks, Grid, Memo, fit_codebooks, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector int"


def wide(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, code, error, label_error) and the digest of the codebooks, with Python's integers."""
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    lengths = [len(r[1]) for r in kept]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = [r for r in kept if len(r[1]) == dim]
    width = -(-dim // parts)
    most = gridcodes.largest(dim)

    def cut(v):
        whole = [max(-most, min(most, int(np.floor(scale * np.float64(np.float32(x)))))) for x in v] + [0] * (width * parts - dim)
        return [whole[p * width : (p + 1) * width] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, [float(np.float32(x)) for x in r[1]]))
    vectors = [cut(r[1]) for r in kept]
    books = [[cut(r[1])[p] for r in ordered[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in vectors:
                members.setdefault(nearest(books[p], v[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(c) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])]
    found = [[nearest(books[p], v[p]) for p in range(parts)] for v in vectors]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    flat = ",".join(str(x) for b in books for e in b for x in e)
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]]) for r, f, e in zip(kept, found, errors)]
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


def check(spark, rows, **labels):
    books = fit_codebooks(wide(spark, rows))
    got = vector_codes(wide(spark, rows), books, **labels)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"]
    want, digest = brute(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()), key=str) == want
    assert books.sha256() == digest


def vectors(rng, n, dim=16, spread=0.3):
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], rng.choice([None, 0, 1, 2])) for i in range(n)]


def test_ties_repeats_nulls_and_unusable_vectors(spark):
    rng = random.Random(1)
    rows = vectors(rng, 200)
    rows += [(i + 1000, rows[i % 5][1], 1) for i in range(90)]  # a third of all rows are copies
    rows += [rows[0], rows[0], (3, rows[8][1], None), (None, rows[4][1], 2)]
    rows += [(400 + i, [float(rng.choice([-1, 0, 1])) for _ in range(16)], 7) for i in range(60)]  # equal distances
    rows += [(-5, None, 1), (-4, [None] * 16, 1), (-3, [float("nan")] * 16, 1), (-2, [float("-inf")] * 16, 1), (-1, [], 1), (-6, [0.5] * 9, 1)]
    check(spark, rows)
    check(spark, rows, send_labels=1)  # labels joined by a shuffle


@pytest.mark.parametrize("dim", [8, 20, 64])
def test_lengths(spark, dim):
    check(spark, vectors(random.Random(dim), 120, dim))


def test_few_vectors_and_equal_vectors(spark):
    check(spark, vectors(random.Random(2), 3))
    check(spark, [(i, [0.25] * 16, 0) for i in range(40)])


def test_huge_components_are_held_to_the_largest(spark):
    rng = random.Random(3)
    check(spark, vectors(rng, 40, 8, 1e5) + [(100, [1e30] * 8, 1), (101, [-3e38] * 8, 1)])


def test_empty_tables(spark):
    none = wide(spark, [(1, None, 1)])
    for df in (none, none.limit(0)):
        assert fit_codebooks(df) is None
        assert vector_codes(df, None).collect() == []


def test_memo_leaves_out_entries_but_never_the_nearest():
    rng = np.random.default_rng(4)
    x = np.floor(1000 * rng.normal(size=(5000, 8))).astype(np.int64)
    entries = x[:16]
    f = x.astype(float)
    grid = Grid.of(len(x), f.min(0), f.max(0), f.sum(0), (f * f).sum(0), 8)
    memo = Memo(entries, grid.inner, grid.low, grid.high)
    d = ((x[:, None, :] - entries) ** 2).sum(axis=2)
    for part in np.array_split(np.arange(len(x)), 7):
        chosen, best = memo.nearest(x[part])
        assert (chosen == d[part].argmin(axis=1)).all() and (best == d[part].min(axis=1)).all()
    cells = np.unique(memo.cell(x))
    kept = np.array([int(b).bit_count() for b in memo.found[cells]])
    assert np.count_nonzero(memo.found) == len(cells) and kept.min() >= 1 and kept.mean() < 12


def test_a_code_restores_its_entries():
    entries = np.arange(2 * 3 * 2).reshape(2, 3, 2)
    books = Codebooks(entries, 3, 4, None)
    assert books.restored("0201") == [4 / 4, 5 / 4, 8 / 4]
