"""Groups of near duplicates equal those of comparing all pairs of sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabgrid.llm import superminhash as smh
from cabgrid.llm.components import connected
from cabgrid.session import checkpoint_root
from cabgrid.llm.superminhash import keep_one, near_duplicates, signatures
from corpus import awkward, empty, frame, rows_of, sentence

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(rows, width, percent=80):
    """{(id, set size): component} by union-find over all similar pairs."""
    sets = []
    for r in rows:
        if r[0] is not None:
            w = (r[1] or "").encode().translate(LOWER).split()
            s = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
            sets.append((r[0], s))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in sets:
        for j, y in sets:
            if i < j and x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i) if s else i, (find(i) if s else i) == i) for i, s in sets)


def check(spark, rows, width=4, **options):
    got = near_duplicates(frame(spark, rows), width, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(rows, width)


@pytest.mark.parametrize("width", [4, 5])
def test_awkward_rows(spark, width):
    check(spark, awkward(random.Random(width)), width)


def near_copies(rng, groups, size, words, edits):
    texts, n = {}, 0
    for _ in range(groups):
        base = sentence(rng, words).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 99)}"
            texts[n * 37 % 1009] = " ".join(w)
            n += 1
    return texts


def test_many_near_copies_with_chains(spark):
    check(spark, rows_of(near_copies(random.Random(1), 6, 30, 150, 8)))


def test_large_buckets_and_many_blocks(spark, monkeypatch):
    for name, value in (("BUCKET_MEMBERS", 6), ("SHARE_ROWS", 50), ("BLOCK_MEMBERS", 5)):
        monkeypatch.setattr(smh, name, value)
    check(spark, rows_of(near_copies(random.Random(2), 4, 25, 100, 7)))


def test_families_of_many_blocks_that_are_not_one_group(spark, monkeypatch):
    """Copies of a template fall in one family; some are linked, by chains over
    blocks that don't lie side by side, most are not."""
    for name, value in (("BUCKET_MEMBERS", 2), ("BLOCK_MEMBERS", 4)):
        monkeypatch.setattr(smh, name, value)
    rng = random.Random(5)
    base = sentence(rng, 60)
    tails = [" ".join(f"t{i}x{k}" for k in range(30)) for i in range(12)]
    texts = {}
    for i in range(12):
        for k in range(5):
            w = tails[i].split()
            for j in range(k):
                w[j * 3] = f"e{i}x{j}"
            texts[i + 100 * k] = base + " " + " ".join(w)
    rows = rows_of(texts)
    groups = {c for _, _, c, _ in brute(rows, 4)}
    assert 12 <= len(groups) < 60
    check(spark, rows)


def test_only_members_that_may_join_are_compared_in_full():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    sign = rng.integers(0, 256, (6, 200)).astype(np.uint8)
    sign[4] = sign[0]  # alike, of another component
    sign[5] = sign[1]  # alike, of one component
    table = pa.table(
        {
            "family": [1] * 6,
            "first": pa.array([1] * 6, pa.int32()),
            "second": pa.array([2] * 6, pa.int32()),
            "rep": list(range(6)),
            "block": pa.array([1, 1, 1, 2, 2, 2], pa.int32()),
            "n": [50] * 6,
            "component": [0, 1, 2, 3, 4, 1],
            "sign": [x.tobytes() for x in sign],
        }
    )
    got = smh._between(80, smh.least_matches(80, 200))(table)
    assert got.column("rep").to_pylist() == [0, 4]


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_keep_one_keeps_one_of_each_group(spark):
    rows = awkward(random.Random(9))
    docs = frame(spark, rows).withColumns({"kept_id": F.lit(1), "kept": F.lit("x")})
    out = keep_one(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    groups = {i: c for i, _, c, _ in brute(rows, 5)}
    assert None in ids
    ids = [i for i in ids if i is not None]
    assert len(ids) == len(set(ids)) and set(ids) == set(groups.values())


def plain_signature(items, size):
    """SuperMinHash element by element, every step walked."""
    out = [2**64 - 1] * size
    for x in items:
        perm = list(range(size))
        for j in range(size):
            with np.errstate(over="ignore"):
                d = int(smh.tx.mix(np.array([x], np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64))[0])
            k = j + (d >> 40) % (size - j)
            perm[j], perm[k] = perm[k], perm[j]
            out[perm[j]] = min(out[perm[j]], d & ((1 << 40) - 1) | j << 40)
    return out


def test_early_stopping_changes_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 5, 20, 60, 200]
    items = rng.integers(0, 2**63, sum(sizes)).astype(np.uint64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    got = signatures(items, first, 24)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        assert got[i].tolist() == plain_signature(items[a:b], 24)
    monkeypatch.setattr(smh, "_STEP_ELEMENTS", 10)
    assert (signatures(items, first, 24) == got).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 2**63, 300).astype(np.uint64)
    y = np.concatenate((x[:240], rng.integers(0, 2**63, 30).astype(np.uint64)))
    s = signatures(np.concatenate((x, y)), np.array([0, 300, 570]), 1000)
    assert abs((s[0] == s[1]).mean() - 240 / 330) < 0.05


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(1, 2), (2, 3), (3, 1), (9, 9), (None, 4)]
    random.Random(1).shuffle(links)
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()))
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {1: 1, 2: 1, 3: 1}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_only_the_result_stays_on_disk(spark):
    import os

    root = checkpoint_root(spark).replace("file:", "")
    before = set(os.listdir(f"{root}/cabgrid-llm")) if os.path.isdir(f"{root}/cabgrid-llm") else set()
    got = near_duplicates(frame(spark, awkward(random.Random(2))), 4)
    left = set(os.listdir(f"{root}/cabgrid-llm")) - before
    assert [os.listdir(f"{root}/cabgrid-llm/{x}") for x in left] == [["groups"]]
    assert got.count() > 0
