"""Shards equal those of the best contiguous partition found by brute force."""

import hashlib
import random
import zlib

import pytest

from cabgrid.llm import sharding
from cabgrid.llm.sharding import balanced_shards
from corpus import awkward, empty, frame, rows_of, sentence


def minimax(sizes, shards):
    """Least largest sum over all ways to cut ``sizes`` into ``shards`` runs."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = total[:]
    for _ in range(shards - 1):
        best = [min(max(best[j], total[i] - total[j]) for j in range(i + 1)) for i in range(len(total))]
    return best[-1]


def check(spark, rows, shards=8):
    got = balanced_shards(frame(spark, rows), shards).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    by_text, size = {}, {}
    for r in rows:
        t = (r[1] or "").encode()
        size[t] = size.get(t, 0) + len(t) + 1
    order = sorted(size, key=lambda t: hashlib.sha256(t).hexdigest())
    shard_of = {(r.size, r.text_crc32): r.shard for r in got}
    placed = [shard_of[len(t) + 1, zlib.crc32(t)] for t in order]
    assert placed == sorted(placed) and all(0 <= s < shards for s in placed)
    sums = [0] * shards
    for t, s in zip(order, placed):
        sums[s] += size[t]
    assert max(sums) == minimax([size[t] for t in order], shards)
    assert {(r.size, r.text_crc32, r.shard) for r in got} == {(a, b, s) for (a, b), s in shard_of.items()}  # equal texts together
    for s in range(shards):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_awkward_rows(spark, shards):
    check(spark, awkward(random.Random(shards)), shards)


@pytest.mark.parametrize("tries", [6, 64])
def test_many_texts_and_a_hot_one(spark, monkeypatch, tries):
    monkeypatch.setattr(sharding, "TRIES", tries)
    monkeypatch.setattr(sharding, "PARTS", 4)
    rng = random.Random(tries)
    check(spark, rows_of({i: "hot text" if i % 3 == 0 else sentence(rng, rng.randint(1, 60)) for i in range(300)}))


def test_empty_table(spark):
    assert balanced_shards(empty(spark)).collect() == []
