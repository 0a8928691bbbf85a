"""Bins keep their size and constraints, hold every word once, and each piece is
in the tightest bin that could take it."""

import random
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from cabgrid.llm.packing import best_fit, pack
from corpus import awkward, empty, frame, rows_of, sentence


def check(spark, rows, capacity, **options):
    got = pack(frame(spark, rows), capacity, **options).collect()
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(len((r[1] or "").split()))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append(r)
    assert set(have) == set(want)
    for i, sizes in want.items():
        assert sum(r.n_words for r in have[i]) == sum(sizes)
        assert len(have[i]) == sum(max(1, -(-n // capacity)) for n in sizes)
        if len(sizes) == 1:
            pieces = sorted(have[i], key=lambda r: r.piece)
            assert [r.piece for r in pieces] == list(range(len(pieces)))
            assert [r.first_word for r in pieces] == [k * capacity for k in range(len(pieces))]
    bins = defaultdict(list)
    for r in got:
        assert (r.bin is None) == (r.n_words == 0) == (r.bin_offset is None)
        if r.bin is not None:
            bins[r.bin].append(r)
    of = {r[0]: (r[3], r[1]) for r in rows}
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in b] == [sum(x.n_words for x in b[:k]) for k in range(len(b))]
        assert sum(r.n_words for r in b) <= capacity
        if len({len(want[r.doc_id]) for r in b} | {1}) == 1:
            sources = [of[r.doc_id][0] for r in b if of[r.doc_id][0] is not None]
            texts = [of[r.doc_id][1] for r in b]
            assert len(sources) == len(set(sources)) and len(texts) == len(set(texts))
    return bins


def test_awkward_rows(spark):
    check(spark, awkward(random.Random(1)), 100)
    check(spark, awkward(random.Random(2)), 2048)


def test_hot_source_copies_and_groups(spark):
    rng = random.Random(3)
    rows = rows_of({i: "a copy of it" if i % 4 == 0 else sentence(rng, rng.randint(1, 90)) for i in range(400)}, lambda i: "hot" if i % 3 else f"s{i % 40}")
    whole = check(spark, rows, 64)
    split = check(spark, rows, 64, group_words=1500)
    assert len(whole) <= len(split)


def test_empty_table(spark):
    assert pack(empty(spark)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 3), st.integers(0, 3)), max_size=400))
def test_each_piece_is_in_the_tightest_compatible_bin(pieces):
    capacity = 30
    sizes, sources, clusters = ([p[0] for p in pieces], [1 << p[1] >> 1 for p in pieces], [1 << p[2] >> 1 for p in pieces])
    bins: list[list[int]] = []
    for (b, offset), size, source, cluster in zip(best_fit(sizes, sources, clusters, capacity), sizes, sources, clusters):
        fits = [x[0] for x in bins if x[0] + size <= capacity and not x[1] & source and not x[2] & cluster]
        if b == len(bins):
            assert not fits
            bins.append([0, 0, 0])
        else:
            assert bins[b][0] == max(fits) and not bins[b][1] & source and not bins[b][2] & cluster
        assert offset == bins[b][0]
        bins[b] = [bins[b][0] + size, bins[b][1] | source, bins[b][2] | cluster]
        assert bins[b][0] <= capacity


def test_many_pieces_of_one_source_take_little_time():
    """Every bin conflicts with every piece; a walk over them would be 5e9 steps."""
    import time

    began = time.process_time()
    placed = best_fit([8] * 100_000, [1] * 100_000, [0] * 100_000, 2048)
    assert [b for b, _ in placed] == list(range(100_000)) and time.process_time() - began < 20
