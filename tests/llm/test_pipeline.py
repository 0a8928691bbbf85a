"""Every stage on its own input, against brute force where SQL can't say it."""

import random
from collections import Counter

import corpus_pipeline as cp
from cabgrid.llm.quality import REJECT_BELOW, fit_quality, quality_posteriors
from cabgrid.llm.toxicity import THRESHOLD, fit_toxicity, toxicity_scores
from conftest import SF001
from corpus import awkward, empty, frame
from test_near_dedup import brute as groups_of
from test_substring_dedup import brute as repeats_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_small_corpus(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = cp.saved(stage(spark, docs, SF001), name)
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == COLUMNS and docs.count() > 0
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = kept["toxicity"]
    scores = toxicity_scores(before, fit_toxicity(before, labels)).collect()
    assert ids(after) == {r.doc_id for r in scores if r.score < THRESHOLD} != ids(before)
    before, after = kept["quality"]
    post = quality_posteriors(before, fit_quality(before, labels)).collect()
    assert ids(after) == {r.doc_id for r in post if r.quality >= REJECT_BELOW} != ids(before)
    before, after = kept["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == {c for _, _, c, _ in groups_of(rows, 5)} != ids(before)
    before, after = kept["substring_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = repeats_of(rows, cp.PASSAGE_WORDS)
    text = dict(rows)
    for r in after.collect():
        n, words = want[r.doc_id, text[r.doc_id]]
        assert r.text.encode().split() == [w.encode() for w in words] and r.n_chars == len(r.text)
        assert r.text == text[r.doc_id] or len(words) < n
    before, after = kept["packing"]
    assert {r.doc_id: r.n for r in after.groupBy("doc_id").sum("n_words").toDF("doc_id", "n").collect()} == {
        r.doc_id: len(r.text.split()) for r in before.collect()
    }


def test_run_chains_the_stages(spark):
    assert cp.run(spark, SF001).count() > 0
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "near_dedup", "substring_dedup", "packing"]


def test_empty_tables(spark):
    docs = empty(spark)
    for name, stage in cp.STAGES:
        after = cp.saved(stage(spark, docs, SF001), name)
        assert after.count() == 0 and (name == "packing" or after.columns == docs.columns)
        docs = after if name != "packing" else docs


def test_awkward_rows(spark):
    """Each stage on all awkward rows, row by row, with every column."""
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs = cp.saved(frame(spark, awkward(random.Random(1))), "awkward")
    rows = [tuple(r) for r in docs.collect()]
    counted = lambda df: Counter(map(tuple, df.select(docs.columns).collect()))
    tox = toxicity_scores(docs.withColumnRenamed("score", "own_score"), fit_toxicity(docs, labels)).where(f"score < {THRESHOLD}")
    assert counted(cp.toxicity(spark, docs, SF001)) == counted(tox.drop("score").withColumnRenamed("own_score", "score"))
    good = quality_posteriors(docs, fit_quality(docs, labels)).where(f"quality >= {REJECT_BELOW}")
    assert counted(cp.quality(spark, docs, SF001)) == counted(good)
    kept = counted(cp.near_dedup(spark, docs, SF001))
    wanted = {i for i, _, c, _ in groups_of([r[:2] for r in rows if r[0] is not None], 5) if i == c}
    assert not set(kept) - set(rows) and sorted(r[0] for r in kept.elements() if r[0] is not None) == sorted(wanted)
    assert Counter(r for r in kept.elements() if r[0] is None) == Counter(r for r in rows if r[0] is None)
    cut = cp.substring_dedup(spark, docs, SF001).collect()
    want = repeats_of([r[:2] for r in rows], cp.PASSAGE_WORDS)
    assert len(cut) == len(rows) and Counter(tuple(r)[2:4] + tuple(r)[5:] for r in cut) == Counter(r[2:4] + r[5:] for r in rows)
    left = Counter((r.doc_id, tuple((r.text or "").split())) for r in cut)
    expected = Counter()
    for i, text, *_ in rows:
        n, words = want[i, text] if i is not None else (0, (text or "").split())
        expected[i, tuple(w if isinstance(w, str) else w.decode() for w in words)] += 1
    assert left == expected
    assert sum(r.text is None for r in cut) == sum(r[1] is None for r in rows)
    pieces = cp.packing(spark, docs, SF001).groupBy("doc_id").sum("n_words").collect()
    words = Counter()
    for i, text, *_ in rows:
        words[i] += len((text or "").split())
    assert {r[0]: r[1] for r in pieces} == dict(words)
