"""The nearest vectors equal those of scoring every pair."""

import random

import numpy as np
import pytest

from cabgrid.llm import topk
from cabgrid.llm.topk import segment_statistics, top_k


def brute(rows, asked, k):
    usable = lambda r: r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])
    ints = lambda v: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]
    base = [(i, ints(v)) for i, v in filter(usable, rows)]
    out = {}
    for i, q in [(i, ints(v)) for i, v in filter(usable, asked)]:
        best = out.setdefault(i, {})
        for j, x in base:
            if i != j:
                best[j] = max(best.get(j, -(2**70)), sum(a * b for a, b in zip(q, x)))
    return sorted((i, n + 1, j, s) for i, best in out.items() for n, (j, s) in enumerate(sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]))


def check(spark, rows, asked=None, k=10):
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0] if asked is None else asked
    schema = "vec_id long, embedding array<float>, id string, score string, v int"
    wide = lambda rs: spark.createDataFrame([(*r, "x", "y", 1) for r in rs], schema).repartition(3)
    got = top_k(wide(rows), wide(asked), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, asked, k)


def vectors(rng, n, d=16):
    return [(i, [rng.gauss(0, 0.3) for _ in range(d)]) for i in range(n)]


def test_ties_repeats_and_unusable_vectors(spark):
    rng = random.Random(1)
    rows = vectors(rng, 300)
    rows += [(i + 1000, rows[i % 7][1]) for i in range(60)]  # equal vectors tie
    rows += [(5, rows[9][1]), (20, rows[3][1]), (40, None), (60, [None] * 16), (80, [float("nan")] * 16), (100, [float("inf")] * 16)]
    rows += [(None, rows[0][1]), (120, [0.5] * 9), (140, []), (160, [0.1] * 20)]
    check(spark, rows)


def test_fewer_candidates_than_asked_for(spark):
    check(spark, vectors(random.Random(2), 4), k=10)
    check(spark, [(0, [1.0, 2.0])], k=10)


def test_small_blocks_and_several_turns(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_BLOCK", 3), ("SEND_BYTES", 1000)):
        monkeypatch.setattr(topk, name, value)
    check(spark, vectors(random.Random(3), 200))


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    check(spark, [(i, [rng.uniform(-4e4, 4e4) for _ in range(8)]) for i in range(60)])


def test_empty_tables(spark):
    assert top_k(*[spark.createDataFrame([], "vec_id long, embedding array<float>")] * 2).collect() == []
    check(spark, vectors(random.Random(5), 30), asked=[])


@pytest.mark.parametrize("segments", [1, 4, 16])
def test_bounds_hold_and_get_tighter(segments):
    rng = np.random.default_rng(6)
    q, x = np.floor(300 * rng.normal(size=(20, 50))), np.floor(300 * rng.normal(size=(30, 50)))
    bound = segment_statistics(q, segments) @ segment_statistics(x, segments).T
    assert (bound >= q @ x.T - 1e-6).all()
    if segments > 1:
        assert bound.sum() < (segment_statistics(q, 1) @ segment_statistics(x, 1).T).sum()
