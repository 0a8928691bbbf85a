"""Removed words equal those of a brute-force search over all windows."""

import random
import tracemalloc

import pytest
from hypothesis import given, settings, strategies as st

import numpy as np
import pyarrow as pa
import pyarrow.compute

from cabgrid.llm import substrings as sub, text as tx
from cabgrid.llm.substrings import remove_repeats
from corpus import awkward, empty, frame, rows_of, sentence


def brute(rows, window):
    """{(id, text): (words, kept words)} by comparing word tuples."""
    first: dict[tuple, int] = {}
    split = [(r[0], r[1], (r[1] or "").encode().split()) for r in rows]
    for i, _, words in split:
        if i is not None:
            for k in range(len(words) - window + 1):
                w = tuple(words[k : k + window])
                first[w] = min(first.get(w, i), i)
    out = {}
    for i, t, words in split:
        gone = [False] * len(words)
        if i is not None:
            for k in range(len(words) - window + 1):
                if first[tuple(words[k : k + window])] < i:
                    gone[k : k + window] = [True] * window
        out[i, t] = (len(words), [w.decode() for w, g in zip(words, gone) if not g])
    return out


def check(spark, rows, window, layout=False):
    got = remove_repeats(frame(spark, rows), window, layout=layout).select("source_row.*", "n_words", "n_removed", "kept_text", "text_is_null").collect()
    texts = {(r[0], None if r[1] is None else len(r[1])): r[1] for r in rows}
    want = brute(rows, window)
    assert len(got) == len(rows)
    for r in got:
        n, kept = want[r.doc_id, texts[r.doc_id, r.n_chars if r.doc_id is not None else len(next(x[1] for x in rows if x[0] is None))]]
        assert (r.n_words, r.n_removed) == (n, n - len(kept))
        assert r.kept_text.encode().split() == [k.encode() for k in kept]
        if not layout:
            assert r.kept_text == " ".join(kept)


@pytest.mark.parametrize("window", [1, 4, 13, 50])
def test_awkward_rows(spark, window):
    check(spark, awkward(random.Random(window)), window)


def test_layout_is_kept(spark):
    rows = awkward(random.Random(3))
    check(spark, rows, 20, layout=True)
    rows = rows_of({1: "a b c d e", 2: "x\n y  a b c d e\t z\n"})
    got = {r.doc_id: r.kept_text for r in remove_repeats(frame(spark, rows), 5).select("source_row.doc_id", "kept_text").collect()}
    assert got == {1: "a b c d e", 2: "x\n y  z\n"}


def test_copies_runs_and_shared_passages(spark, monkeypatch):
    rng = random.Random(5)
    passage = sentence(rng, 30)
    texts = {}
    for i in range(200):
        kind = i % 4
        texts[i] = {0: "hot copy " + passage, 1: sentence(rng, 30) + " " + passage + " " + sentence(rng, 5), 2: "run " * rng.randint(1, 60), 3: sentence(rng, 50)}[kind]
    monkeypatch.setattr(sub, "SLICE_BYTES", 2000)
    check(spark, rows_of(texts), 13)


def test_empty_table(spark):
    assert remove_repeats(empty(spark), 13).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=80), min_size=1, max_size=6), st.integers(1, 30))
def test_equal_windows_have_equal_representatives(texts, window):
    at, t, name, seen = sub.windows_of(*tx.string_bytes(pa.array(texts)), window)
    known = {}
    words = [x.split() for x in texts]
    assert len(at) == sum(max(0, len(w) - window + 1) for w in words)
    for d, k, n, s in zip(at, t, name, seen):
        assert known.setdefault(tuple(words[d][k : k + window]), (n, s)) == (n, s)
    assert len(set(known.values())) == len(known)


def found_of(texts, window, buckets=16):
    """{doc: first words of its repeated windows}, from the functions that tasks run."""
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([0] * len(texts), pa.int32())], names=["doc", "text", "tag"])
    sent = pa.Table.from_batches([b for k in range(len(texts)) for b in sub._send(window, buckets)(iter([batch.slice(k, 1)]))])
    found = {}
    for bucket in set(sent.column("bucket").to_pylist()):
        for r in sub._settle(sent.filter(pa.compute.equal(sent.column("bucket"), bucket))).to_pylist():
            for first, n in np.frombuffer(r["starts"], np.uint32).reshape(-1, 2):
                found.setdefault(r["doc"], set()).update(range(first, first + n))
    return found


def sent_in_one_bucket(texts, window, at_once=50):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([0] * len(texts), pa.int32())], names=["doc", "text", "tag"])
    return pa.Table.from_batches([b for k in range(0, len(texts), at_once) for b in sub._send(window, 1)(iter([batch.slice(k, at_once)]))])


@pytest.mark.parametrize("copied", [False, True])
def test_settling_a_bucket_takes_little_beside_it(copied):
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 2000))) for _ in range(400)]
    table = sent_in_one_bucket(texts[:200] * 2 if copied else texts, 50)
    tracemalloc.start()
    try:
        found = sub._settle(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.num_rows == (200 if copied else 0)
    assert peak < (5 if copied else 1.5) * table.nbytes


def test_windows_compared_in_parts_are_the_same(monkeypatch):
    rng = random.Random(12)
    shared = [sentence(rng, 40) for _ in range(5)]
    texts = [" ".join([sentence(rng, 20), rng.choice(shared), "run " * 20, sentence(rng, 20)]) for _ in range(60)]
    whole = found_of(texts, 13, 1)
    assert whole
    for most in (1, 7, 500):
        monkeypatch.setattr(sub, "SETTLED_WINDOWS", most)
        assert found_of(texts, 13, 1) == whole


def test_windows_that_share_a_name_and_half_their_hash_are_not_repeats(monkeypatch):
    texts = ["a b c d e", "v w x y z", "q b c d e", "a b c d e"]
    whole = tx.hash_long_windows
    for half in (0xFFFFFFFF, 0xFFFFFFFF << 32):
        monkeypatch.setattr(tx, "hash_long_windows", lambda *a, half=half: whole(*a) & np.uint64(half))
        monkeypatch.setattr(sub, "_range_min", lambda values, lo, hi: np.full(len(lo), 7, np.uint64))
        assert found_of(texts, 4) == {2: {1}, 3: {0, 1}}


def test_windows_of_a_heavy_name_are_spread(spark, monkeypatch):
    rng = random.Random(8)
    passage = sentence(rng, 20)
    # One frequent word, of the lowest hash, represents much of all windows.
    words = [f"w{k}" for k in range(5000)]
    starts, ends, _ = tx.find_words(*tx.string_bytes(pa.array(words)))
    low = words[int(tx.hash_spans(tx.string_bytes(pa.array(words))[0], starts, ends).argmin())]
    texts = {i: " ".join(f"{low} {rng.choice(words)}" for _ in range(60)) + (" " + passage if i % 3 == 0 else "") for i in range(120)}
    rows = frame(spark, rows_of(texts)).selectExpr("doc_id as doc", "text")
    names, parts = sub.heavy_names(rows, 5, 400)
    assert len(names) and (np.diff(names) > 0).all() and (parts >= 4).all()
    batch = pa.record_batch([pa.array(list(texts), pa.int64()), pa.array(list(texts.values())), pa.array([0] * len(texts), pa.int32())], names=["doc", "text", "tag"])
    most = []
    for heavy in ((np.zeros(0, np.uint64),) * 2, (names, parts)):
        sizes = {}
        for b in sub._send(5, 64, heavy)(iter([batch])):
            for r in b.to_pylist():
                sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + len(r["seen"]) // 8
        most.append(max(sizes.values()) / sum(sizes.values()))
    assert most[1] < most[0] / 2
    found = [{(r.doc, w) for r in sub.repeated_windows(frame(spark, rows_of(texts)), 5, heavy=h).collect() for f, n in np.frombuffer(r.starts, np.uint32).reshape(-1, 2) for w in range(f, f + n)} for h in (400, 1 << 40)]
    assert found[0] == found[1] and found[0]


def test_counts_of_frequent_names_are_bounded():
    names = np.array([5, 1, 5, 2, 3, 5, 4, 2], dtype=np.uint64)
    assert [x.tolist() for x in sub._frequent(names, np.ones(8, np.int64), 8)] == [[1, 2, 3, 4, 5], [1, 2, 1, 1, 3]]
    assert [x.tolist() for x in sub._frequent(names, np.ones(8, np.int64), 2)] == [[2, 5], [1, 2]]


def test_rounds_leave_a_determined_symbol():
    assert [sub.rounds_for(w) for w in (1, 4, 5, 12, 13, 28, 29, 60, 61)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]


def test_range_minimum():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1000, 50).astype(np.uint64)
    lo = rng.integers(0, 50, 200)
    hi = np.minimum(lo + rng.integers(0, 20, 200), 49)
    assert (sub._range_min(v, lo, hi) == [v[a : b + 1].min() for a, b in zip(lo, hi)]).all()
