"""Ids equal the SentencePiece library's, and decode to the texts."""

import random
import struct
import time

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("tokenizers")

from cabgrid.llm import spm  # noqa: E402
from cabgrid.llm.queries import SPM_PATH  # noqa: E402
from corpus import awkward, empty, frame  # noqa: E402

BITS = ["a", "b", " ", "the", " ing", "\n", "é", "語", "=", "-", "  ", "\t", "🙂", "<s>", "<0x41>", "\x00"]


@pytest.fixture(scope="module")
def model():
    return spm.read_model(SPM_PATH)


def texts(n=400, seed=1):
    rng = random.Random(seed)
    return [""] + ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["a" + " " * k + "b" for k in range(1, 70)] + ["x" * 3000]


def test_whole_texts_equal_the_library(model):
    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    some = texts()
    ids = spm.encode_batch(model, some)
    assert ids == reader.encode(some)
    assert spm.decode_batch(model, ids) == some


def test_pieces_stand_for_what_decoding_gives(model):
    some = texts(seed=2)
    stands_for = spm.SpmModel.parse(model).piece_bytes()
    ids = spm.encode_batch(model, some)
    assert [b"".join(stands_for[i] for i in x).decode()[1:] for x in ids] == spm.decode_batch(model, ids) == some


@pytest.mark.parametrize("most", [-1, 0, 1, 12, 1 << 40])
def test_texts_cut_into_words_and_whole_ones_have_the_same_ids(model, monkeypatch, most):
    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    monkeypatch.setattr(spm, "WHOLE_CHARS", most)
    some = texts(seed=3) + ["▁", " ▁ a▁b", " " * 300, "a b " * 5000]
    assert spm.encode_batch(model, some) == reader.encode(some)
    assert spm.encode_batch(model, []) == []


def test_short_texts_take_less_time_than_a_cut_into_words(model):
    rng = random.Random(4)
    some = [" ".join(rng.choice("etaoin") + str(rng.randrange(10**6)) + rng.choice(["ing", "er", "ung"]) for _ in range(300)) for _ in range(200)]
    by_words = spm.SpmModel.parse(model).tokenizer()

    def seconds(encode):
        took = []
        for _ in range(5):
            at = time.process_time()
            got = encode()
            took.append(time.process_time() - at)
        return min(took), got

    now, ids = seconds(lambda: spm.encode_batch(model, some))
    cut, same = seconds(lambda: [e.ids for e in by_words.encode_batch_fast(some, add_special_tokens=False)])
    assert ids == same
    assert now < 0.85 * cut


def message(*fields):
    """A protocol buffer message of (number, value) fields."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        else:
            out += varint(number << 3) + varint(value)
    return out


def small_unigram(squeeze, fallback):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    pieces += [("▁", -2.0, 1), ("▁a", -2.5, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("ab", -3.5, 1), ("▁ab", -4.2, 1), ("ba", -4.0, 1), ("aba", -6.0, 1), ("é", -5.0, 1)]
    trainer = message((3, 1), (4, len(pieces)), (35, int(fallback)), (40, 0), (41, 1), (42, 2))
    normal = message((1, b"identity"), (3, 1), (4, int(squeeze)), (5, 1))
    return message(*[(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces], (2, trainer), (3, normal))


@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_models(squeeze, fallback):
    data = small_unigram(squeeze, fallback)
    reader = sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(5)
    some = ["".join(rng.choice(["a", "b", " ", "é", "z", "語"]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    assert spm.encode_batch(data, some) == reader.encode(some)
    parsed = spm.SpmModel.parse(data)
    assert (parsed.model_type, parsed.byte_fallback, parsed.squeeze_spaces, parsed.unk_id) == (spm.UNIGRAM, fallback, squeeze, 0)


def test_awkward_rows(spark, model):
    docs = frame(spark, awkward(random.Random(1)))
    rows = spm.encoded(docs, model, parity_every=1).collect()
    assert len(rows) == docs.count() and all(r.parity and r.round_trip for r in rows)
    want = sorted((str(r.doc_id), spm.encode_batch(model, [r.text or ""])[0]) for r in docs.collect())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, np.int32).tolist()) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    assert {r.parity for r in spm.encoded(docs, model, parity_every=0).collect()} == {None}
    assert {r.parity for r in spm.encoded(docs, model, parity_every=2).collect()} == {None, True}
    assert spm.encoded(empty(spark), model).collect() == []


def test_columns_round_trip(spark, model):
    docs = frame(spark, awkward(random.Random(2)))
    both = docs.withColumn("ids", spm.encode_column(model)("text")).withColumn("back", spm.decode_column(model)("ids"))
    assert all(r.back == (r.text or "") for r in both.collect())
