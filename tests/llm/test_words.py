"""Word positions and hashes equal plain Python's, text by text."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from cabgrid.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x0c\r|Z語", max_size=40)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_split(texts):
    data, offs = tx.string_bytes(pa.array(texts, pa.string()))
    starts, ends, first = tx.find_words(data, offs)
    hashes = tx.hash_spans(data, starts, ends)
    seen = {}
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        got = [data[a:b].tobytes() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert got == words
        for w, h in zip(words, hashes[first[i] : first[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 15))
def test_both_window_hashes_agree(items, width):
    x = np.array(items, dtype=np.uint64)
    assert (tx.hash_windows(x, width) == tx.hash_long_windows(x, width)).all()


def test_hash_doesnt_depend_on_the_block(monkeypatch):
    data = np.frombuffer(("word " * 500 + "x" * 3000).encode(), np.uint8)
    starts, ends, _ = tx.find_words(data, np.array([0, len(data)]))
    whole = tx.hash_spans(data, starts, ends)
    monkeypatch.setattr(tx, "_HASH_LANES", 8)
    assert (tx.hash_spans(data, starts, ends) == whole).all()


def test_words_that_defeat_polynomials_have_different_hashes():
    """A Thue-Morse word and its complement agree in every polynomial modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    words = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    words += ["a" * n for n in range(1, 40)] + ["\0" * n for n in range(1, 40)] + ["b" * 8 + "a" * 8, "a" * 8 + "b" * 8]
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    hashes = tx.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)
    assert len(set(hashes.tolist())) == len(set(words))


def test_slices_cover_the_batch_in_order():
    batch = pa.record_batch([pa.array(["a" * n for n in (5, 0, 100, 3, 3, 3)] + [None])], names=["text"])
    parts = list(tx.slices(batch, "text", 8))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert len(parts) > 2 and not list(tx.slices(batch.slice(0, 0), "text"))
