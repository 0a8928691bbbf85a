"""Held-out accuracy, and scores that don't move when identity terms are swapped."""

import math
import random
import re

import numpy as np
import pytest

from cabgrid.llm import toxicity as tox
from cabgrid.llm.logistic import fit, sigmoid
from cabgrid.llm.text import mix
from cabgrid.llm.toxicity import fit_toxicity, held_out, keep_civil, toxicity_scores
from conftest import SF001
from corpus import awkward, empty, frame, sentence

DATA = SF001.replace("sf0.001", "sf0.1")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, fit_toxicity(docs, labels)


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = toxicity_scores(docs, model).join(labels, "doc_id").where(held_out("doc_id")).select("score", "toxic").collect()
    assert len(rows) > 500
    right = [(r.score >= tox.THRESHOLD) == bool(r.toxic) for r in rows]
    toxic = [r.score >= tox.THRESHOLD for r in rows if r.toxic]
    assert np.mean(right) > 0.97 and np.mean(toxic) > 0.85
    assert all(0 <= r.score <= 1 for r in rows)


def plain_score(model, text):
    """The score from the words themselves: lower-cased runs of ASCII letters and
    digits and of other characters, each feature once."""
    words = re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    terms = {w for family in tox.IDENTITY_TERMS.values() for w in family}
    hashes = {int(tox._word_hash([w])[0]) for w in words}
    for size in tox.PREFIXES:
        begins = {w[:size] for w in words if w not in terms and len(w) >= size}
        hashes |= {int(mix(tox._word_hash([b]) + np.uint64(size))[0]) for b in begins}
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    return 1 / (1 + math.exp(-model.intercept - sum(weight.get(h, 0.0) for h in hashes)))


def test_scores_equal_plain_pythons(spark, fitted):
    docs, _, model = fitted
    rows = toxicity_scores(docs.where("doc_id < 400"), model).collect() + toxicity_scores(frame(spark, awkward(random.Random(4))), model).collect()
    assert len(model.hashes) > 100
    for r in rows:
        assert float(r.score) == pytest.approx(plain_score(model, r.text), abs=1e-9)


def test_chosen_features_are_the_most_separating(spark):
    """Against counting them in Python; a feature of too few documents isn't chosen."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        toxic = int(i % 3 == 0)
        own = [h for h, (a, b) in {11: (0.9, 0.1), 12: (0.1, 0.8), 13: (0.5, 0.5), 14: (0.7, 0.2)}.items() if rng.random() < (a if toxic else b)]
        rows.append((toxic, np.array(sorted({*own, 15} if i in (0, 3) else own), dtype=np.uint64).tobytes(), []))
    sample = spark.createDataFrame(rows, "toxic int, features binary, swaps array<int>").repartition(3)
    assert set(tox.separating_features(sample, 100, 200).tolist()) == {11, 12, 14}


def biased(rng, n):
    """A term that occurs mostly in toxic sentences, but doesn't make them so."""
    texts, labels = {}, {}
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = sentence(rng, 12).split()
        if toxic and rng.random() < 0.9:
            words.append("vilething")
        if rng.random() < (0.7 if toxic else 0.05):
            words.insert(3, "muslim")
        if rng.random() < 0.1:
            words.insert(5, "christian")
        texts[i], labels[i] = " ".join(words), toxic
    return texts, labels


def test_swapped_identity_terms_hardly_change_scores(spark, monkeypatch):
    texts, labels = biased(random.Random(1), 1500)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    label = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    plain = [f"the {t} people met in town" for t in ("muslim", "christian", "hindu")]
    model = fit_toxicity(docs, label)
    assert np.ptp(model.logits(plain)) < 0.2
    assert model.logits(["a vilething here"])[0] - model.logits(["a thing here"])[0] > 2
    monkeypatch.setattr(tox, "SWAP_WEIGHT", 0.0)
    assert np.ptp(fit_toxicity(docs, label).logits(plain)) > 1


def test_awkward_rows_get_scores_and_stay_whole(spark, fitted):
    _, _, model = fitted
    docs = frame(spark, awkward(random.Random(2)))
    out = toxicity_scores(docs, model, name="toxic_score")
    assert out.columns == [*docs.columns, "toxic_score"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 < r.toxic_score < 1 for r in rows)
    blank = {r.toxic_score for r in rows if not (r.text or "").strip()}
    assert len(blank) == 1 and blank == {float(sigmoid(np.array([model.intercept]))[0])}
    kept = keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.toxic_score < tox.THRESHOLD for r in rows)
    assert toxicity_scores(empty(spark), model).collect() == []


def test_insult_deep_in_a_long_text_counts(spark, fitted):
    docs, _, model = fitted
    long = "the of and to " * 20_000
    assert model.logits([long + " moron scum " + long])[0] > model.logits([long])[0] + 3


def test_labels_that_cant_be_learned_from(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(40)], "doc_id long, text string")
    for rows in ([], [(i, 0) for i in range(40)], [(None, 1), (3, None), (5, 7), (999, 1)]):
        model = fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert {0 <= r.score <= 1 for r in toxicity_scores(docs, model).collect()} == {True}


def test_newton_finds_the_minimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < sigmoid(0.5 + x @ np.array([1.0, -2.0, 0.0]))).astype(float)
    w = fit(x, y, np.ones(400), np.diag([0, 0.1, 0.1, 0.1]))
    full = np.c_[np.ones(400), x]
    slope = full.T @ (sigmoid(full @ w) - y) + np.array([0, 0.1, 0.1, 0.1]) * w
    assert np.abs(slope).max() < 1e-3
