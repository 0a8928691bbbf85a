"""Every id lies in one piece, no sequence exceeds a limit or is padded, and each
next piece is the one that a plain search over all pieces chooses."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cabgrid.llm.queries import QUERIES, TOKENIZER_PATH
from cabgrid.llm.byte_bpe import Encoder, read_tokenizer
from cabgrid.llm.vector_packing import Example, Limits, Pool, pack_examples, sequences
from conftest import SF01
from corpus import awkward, empty, frame, rows_of, sentence

TOK = Tokenizer.from_file(TOKENIZER_PATH)
DATA = read_tokenizer(TOKENIZER_PATH)
BY_WORD, FORGETS = Encoder(DATA), Encoder(DATA, memo_words=3)


def ids_of(text, prompt=None):
    return [TOK.encode(t or "", add_special_tokens=False).ids for t in (prompt, text)]


def check(rows, examples, limits=Limits()):
    """``examples``: (id, prompt ids, ids with the end id) of every input row."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for some in by_sequence.values():
        some.sort(key=lambda r: r.offset)
        assert [r.offset for r in some] == [sum(x.length for x in some[:i]) for i in range(len(some))]
        n = sum(r.length for r in some)
        assert n <= limits.tokens and len(some) <= limits.segments
        assert n == limits.tokens or n & (n - 1) == 0
        if "loss_tokens" in rows[0]:
            assert sum(r.loss_tokens for r in some) <= limits.loss
    want = Counter()
    for id, prompt, ids in examples:
        want[(id, len(prompt) + len(ids), tuple(prompt + ids))] += 1
    pieces = defaultdict(Counter)
    for r in rows:
        assert r.length > 0
        pieces[(r.doc_id, r.doc_tokens)][(r.start, r.length, r.ids_crc32)] += 1
    for (id, n, ids), times in want.items():
        mine, whole = pieces[(id, n)], np.array(ids, dtype="<u4")
        for _ in range(times):
            at = 0
            while at < n:
                s, length, crc = next(p for p in sorted(mine) if p[0] == at and zlib.crc32(whole[at : at + p[1]].tobytes()) == p[2])
                mine[(s, length, crc)] -= 1
                mine += Counter()
                at += length
        pieces[(id, n)] = mine
    assert not any(sum(m.values()) for m in pieces.values())


def test_query_over_whole_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    rows = QUERIES["op13_sequences"](spark, SF01).collect()
    check(rows, [(r.doc_id, [], ids_of(r.text)[1] + [1]) for r in docs])


@pytest.mark.parametrize("window", [1 << 21, 3000])
def test_awkward_rows(spark, window):
    rows = awkward(random.Random(1))
    got = pack_examples(frame(spark, rows), DATA, window=window).collect()
    check(got, [(r[0], [], ids_of(r[1])[1] + [1]) for r in rows])


def test_prompts_bear_no_loss(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(1, 60)), sentence(rng, rng.randrange(0, 90)) or None) for i in range(120)] + [(7, None, None)]
    limits = Limits(256, 6, 96)
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt string").repartition(2)
    got = pack_examples(df, DATA, limits, prompt_col="prompt").collect()
    check(got, [(i, ids_of(t, p)[0], ids_of(t, p)[1] + [1]) for i, t, p in rows], limits)
    loss = Counter()
    for r in got:
        loss[r.doc_id] += r.loss_tokens
    want = Counter()
    for i, t, _ in rows:
        want[i] += len(ids_of(t)[1]) + 1
    assert loss == want


def test_many_tiny_documents_meet_the_limit_of_segments(spark):
    rows = rows_of({i: "a" if i % 40 else "b c d e f g " * 60 for i in range(900)})
    got = pack_examples(frame(spark, rows), DATA, Limits(512, 16, 512)).collect()
    check(got, [(r[0], [], ids_of(r[1])[1] + [1]) for r in rows], Limits(512, 16, 512))


def test_empty_table_and_limits(spark):
    assert pack_examples(empty(spark), DATA).collect() == []
    with pytest.raises(ValueError):
        pack_examples(empty(spark), DATA, Limits(0, 1, 1))


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "don't", "'s", "é", "7", ".", "<|endoftext|>", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "\u180e", "½", "一"]), max_size=12)
    .map("".join)
    | st.text(max_size=20)
)
def test_ids_by_words_are_those_of_the_whole_text(text):
    for encode in (BY_WORD, FORGETS):
        assert np.frombuffer(encode([text, "x " + text])[0], "<u4").tolist() == TOK.encode(text, add_special_tokens=False).ids
    assert BY_WORD.by_word and len(FORGETS.memo) <= 3


def test_other_tokenizers_encode_whole_texts():
    encode = Encoder(read_tokenizer(TOKENIZER_PATH.replace("byte_bpe_50k", "word_bpe_49k")))
    other = Tokenizer.from_file(TOKENIZER_PATH.replace("byte_bpe_50k", "word_bpe_49k"))
    for text in ("Two  Words", "", " \n", "don't <|endoftext|> stop"):
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == other.encode(text, add_special_tokens=False).ids
    assert not encode.by_word


def test_no_padding_and_few_cuts():
    rng = random.Random(3)
    pool = Pool()
    for i in range(3000):
        pool.add_cut(Example(i, np.zeros(int(rng.lognormvariate(5, 1.2)) + 1, "<u4")), 0, Limits())
    pieces, total = int(pool.count.sum()), pool.total
    made = list(sequences(pool, Limits()))
    sizes = [sum(p[2] for p in s) for s in made]
    assert sum(sizes) == total and sum(n < 2048 for n in sizes) <= 11
    assert sum(map(len, made)) <= pieces + len(made) + 11


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 20)), min_size=1, max_size=30), st.integers(4, 64), st.integers(1, 6), st.integers(1, 40))
def test_each_piece_is_the_one_that_a_plain_search_chooses(sizes, tokens, segments, loss):
    limits = Limits(tokens, segments, loss)
    pool = Pool()
    for i, (n, prompt) in enumerate(sizes):
        pool.add_cut(Example(i, np.arange(n + prompt, dtype="<u4"), prompt), 0, limits)
    total, seen, again = pool.total, 0, pool
    free = lambda: [(p, p[2], p[0].loss(*p[1:])) for kind in again.pieces for p in kind]
    while again.total:
        before = free()
        (chosen,) = [s for _, s in zip(range(1), sequences(again, limits))]
        room = [tokens, segments, loss]
        for p in chosen:
            mine = p[2], p[0].loss(*p[1:])
            fitting = [x for x in before if x[1] <= room[0] and x[2] <= room[2]]
            score = lambda t, l: Fraction(t * room[0], tokens**2) + Fraction(l * room[2], loss**2)
            if any(x[0] == p for x in fitting):
                assert score(*mine) >= max(score(x[1], x[2]) for x in fitting) - Fraction(1, 10**9)
                before.remove((p, *mine))
            else:  # cut: to fill the room, or at the end to a power of two
                assert p is chosen[-1] or not fitting or p[2] < max(x[1] for x in before)
                break
            room = [room[0] - mine[0], room[1] - 1, room[2] - mine[1]]
        seen += sum(p[2] for p in chosen)
    assert seen == total
