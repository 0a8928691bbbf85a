"""Held-out accuracy, and posteriors that equal the formulas computed by hand."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from cabgrid.llm import quality as q
from cabgrid.llm.quality import fit_quality, keep_good, quality_posteriors, site_table
from cabgrid.llm.toxicity import held_out
from conftest import SF001
from corpus import awkward, empty, frame

DATA = SF001.replace("sf0.001", "sf0.1")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, fit_quality(docs, labels)


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = quality_posteriors(docs, model).join(labels.withColumnRenamed("quality", "label"), "doc_id").where(held_out("doc_id"))
    rows = rows.select("quality", "label").collect()
    assert len(rows) > 500
    assert np.mean([(r.quality >= q.REJECT_BELOW) == bool(r.label) for r in rows]) > 0.98
    assert np.mean([r.quality >= q.REJECT_BELOW for r in rows if r.label]) > 0.995


@pytest.mark.parametrize("path_effect", [0.0, 0.15])
def test_posteriors_come_near_a_simulated_truth(spark, path_effect):
    """Paths that tell nothing leave the host's estimate alone; those that do improve on it."""
    rng = np.random.default_rng(7)
    rows, truth = [], {}
    for h in range(20):
        host = 0.5 + 0.1 * rng.normal()
        for p in range(200):
            truth[f"h{h}", f"p{p}"] = site = host + path_effect * rng.normal()
            rows += [(f"h{h}", f"p{p}", float(np.clip(site + 0.1 * rng.normal(), 0.01, 0.99))) for _ in range(3)]
    got = site_table(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    off = lambda c: float(np.sqrt(np.mean([(r[c] - truth[r.host, r.path]) ** 2 for r in got])))
    if path_effect:
        assert off("p_path") < 0.6 * off("p_host")
    else:
        assert off("p_path") < 1.05 * off("p_host") + 0.001


def test_sites_equal_the_formulas(spark):
    rng = random.Random(3)
    rows = [(f"h{i % 5}" if i % 7 else None, f"p{i % 3}", min(0.99, 0.1 + 0.15 * (i % 5) + 0.2 * rng.random())) for i in range(600)]
    rows += [("sparse", "p", 0.99), ("sparse2", None, 0.01)]
    mean = sum(p for *_, p in rows) / len(rows)

    def strength(groups, parents):
        """Method of moments, from the lists of numbers themselves."""
        free = sum(len(g) - 1 for g in groups)
        within = sum((x - sum(g) / len(g)) ** 2 for g in groups for x in g) / free
        spread = sum(len(g) * (sum(g) / len(g) - sum(p) / len(p)) ** 2 for g, p in zip(groups, parents))
        expected = sum(1 - len(g) / len(p) for g, p in zip(groups, parents)) * within
        between = max((spread - expected) / sum(len(g) - len(g) ** 2 / len(p) for g, p in zip(groups, parents)), 0)
        return min(max(within / between, 1), 10_000) if between > 0 else 10_000

    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        hosts[h].append(x)
        paths[h, p].append(x)
    everything = [p for *_, p in rows]
    kh = strength(list(hosts.values()), [everything] * len(hosts))
    kp = strength(list(paths.values()), [hosts[h] for h, _ in paths])
    got = {(r.host, r.path): r for r in site_table(spark.createDataFrame(rows, "host string, path string, p double"), 0.5).collect()}
    assert set(got) == set(paths)
    for (h, p), xs in paths.items():
        p_host = (sum(hosts[h]) + kh * mean) / (len(hosts[h]) + kh)
        p_path = (sum(xs) + kp * p_host) / (len(xs) + kp)
        logit = lambda v: math.log(v / (1 - v))
        r = got[h, p]
        assert (r.p_host, r.p_path, r.surplus) == pytest.approx((p_host, p_path, 0.5 * (logit(p_path) - logit(mean))))
    sparse = got["sparse", "p"]
    assert sparse.p_path < 0.95 and abs(sparse.p_host - mean) < 0.5  # one document doesn't make a site


def test_awkward_rows(spark, fitted, monkeypatch):
    model = fitted[2]
    docs = frame(spark, awkward(random.Random(2)))
    out = quality_posteriors(docs, model)
    assert out.columns == [*docs.columns, "p_document", "p_host", "p_path", "quality"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 < r.quality < 1 for r in rows)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.quality >= q.REJECT_BELOW for r in rows)
    monkeypatch.setattr(q, "SEND_SITES", 1)  # sites too many to send are joined by a shuffle
    again = quality_posteriors(docs, model).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.quality)
    assert [key(r)[:2] for r in sorted(again, key=key)] == [key(r)[:2] for r in sorted(rows, key=key)]
    assert sorted(r.quality for r in again) == pytest.approx(sorted(r.quality for r in rows))
    assert quality_posteriors(empty(spark), model).collect() == []
    assert keep_good(empty(spark), model).collect() == []


def test_labels_that_cant_be_learned_from(spark):
    docs = spark.createDataFrame([(i, "some text", "s", "en") for i in range(40)], "doc_id long, text string, source string, lang string")
    for rows in ([], [(i, 1) for i in range(40)], [(None, 1), (3, None), (5, 7), (999, 1)]):
        model = fit_quality(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {0 <= r.quality <= 1 for r in quality_posteriors(docs, model).collect()} == {True}
