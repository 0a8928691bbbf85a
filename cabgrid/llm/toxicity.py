"""Toxicity scores by a counterfactually regularised classifier.

Features are the presence of words and of word beginnings (4 to 6 characters).
A bounded sample of labelled documents chooses those that separate toxic from
other documents and fits a logistic model. Identity terms (words that name
groups of people) have weights of their own and no beginnings. For every
sampled sentence with such a term, swapping it for another term of its family
changes the logit by the difference of the two weights; the squared changes of
all swaps are part of the loss. A term that merely occurs more often in toxic
sentences can't keep a weight that its neighbours don't have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.logistic import fit, sigmoid
from cabgrid.llm.scratch import Scratch, small_batches

U64 = tx.U64
PREFIXES = (4, 5, 6)
#: Families of identity terms; a swap stays in its family.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "religion": ("christian", "christians", "muslim", "muslims", "jewish", "jews", "hindu", "hindus", "buddhist", "buddhists", "atheist", "atheists"),
    "origin": ("american", "african", "asian", "european", "mexican", "chinese", "indian", "arab", "immigrant", "immigrants", "refugee", "refugees"),
    "colour": ("black", "white", "brown", "latino", "latina", "hispanic"),
    "gender": ("women", "men", "woman", "man", "transgender", "female", "male", "nonbinary"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    "age and health": ("old", "young", "elderly", "disabled", "blind", "deaf"),
}
#: Labelled documents to fit on: at most so many toxic and so many others.
SAMPLE_TOXIC, SAMPLE_OTHER = 2_500, 5_000
#: Features kept, and the least separation (in standard errors) of a kept one.
FEATURES, LEAST_Z = 512, 5.0
RIDGE, SWAP_WEIGHT = 0.01, 10.0
THRESHOLD = 0.3
SLICE_BYTES = 512 << 10
_SENTENCE = re.compile(r"[.!?\n]+")


def _word_hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return tx.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


def identity_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all identity terms, sorted, and the family of each."""
    words = [(w, k) for k, family in enumerate(IDENTITY_TERMS.values()) for w in family]
    hashes = _word_hash([w for w, _ in words])
    order = np.argsort(hashes)
    return hashes[order], np.array([k for _, k in words])[order]


def features_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, feature hash) of all words, then of each kind of beginning.
    Words are lower-cased; ASCII characters other than letters and digits part them."""
    raw = [t.lower().encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    letter = (data >= 128) | ((data - np.uint8(97)) < 26) | ((data - np.uint8(48)) < 10)
    data = np.where(letter, data, np.uint8(32))
    starts, ends, first = tx.find_words(data, offs)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    words = tx.hash_spans(data, starts, ends)
    yield of, words
    known, _ = identity_hashes()
    plain = ~np.isin(words, known)
    starts, ends, of = starts[plain], ends[plain], of[plain]
    begins = (data & 0xC0) != 0x80
    places = np.append(np.flatnonzero(begins), [len(data)] * (max(PREFIXES) + 1))
    nth = np.cumsum(begins)[starts] - 1 if len(starts) else starts
    for size in PREFIXES:
        to = places[nth + size]
        long = to <= ends
        yield of[long], tx.mix(tx.hash_spans(data, starts[long], to[long]) + U64(size))


@dataclass(frozen=True)
class ToxicityModel:
    """Intercept, sorted feature hashes and their weights."""

    intercept: float
    hashes: np.ndarray
    weights: np.ndarray

    def logits(self, texts: list[str]) -> np.ndarray:
        """Each feature counts once for a text, however often it occurs."""
        found = []
        for of, h in features_of(texts):
            slot = np.searchsorted(self.hashes, h)
            slot[slot == len(self.hashes)] = 0
            hit = self.hashes[slot] == h if len(self.hashes) else np.zeros(len(h), bool)
            found.append(of[hit] * np.int64(len(self.hashes)) + slot[hit])
        seen = np.unique(np.concatenate(found))
        out = np.full(len(texts), self.intercept)
        if len(seen):
            np.add.at(out, seen // len(self.hashes), self.weights[seen % len(self.hashes)])
        return out

    def score_column(self):
        """An Arrow UDF from text to a score between 0 and 1; null counts as empty."""

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            batch = pa.record_batch([column], names=["text"])
            parts = [self.logits([t or "" for t in p.column("text").to_pylist()]) for p in tx.slices(batch, "text", SLICE_BYTES)]
            return pa.array(sigmoid(np.concatenate(parts)) if parts else np.zeros(0), pa.float64())

        return score


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, distinct features, and the (term, swap) places of each sample text."""
    known, family = identity_hashes()
    for batch in batches:
        for part in tx.slices(batch, "text", SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            by_kind = list(features_of(texts))
            of, h = (np.concatenate(x) for x in zip(*by_kind))
            order = np.lexsort((h, of))
            of, h = of[order], h[order]
            new = np.ones(len(of), dtype=bool)
            new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
            of, h = of[new], h[new]
            cuts = np.searchsorted(of, np.arange(len(texts) + 1))
            swaps = []
            for t, a, b in zip(texts, cuts[:-1], cuts[1:]):
                mine: list[int] = []
                if np.isin(h[a:b], known).any():
                    for s in _SENTENCE.split(t):
                        words = re.findall(r"[a-z]+", s.lower())
                        there = np.flatnonzero(np.isin(known, _word_hash(words))) if words else []
                        mine += [int(x) * len(known) + int(y) for x in there for y in np.flatnonzero(family == family[x]) if y not in there]
                swaps.append(mine)
            yield pa.record_batch(
                [part.column("toxic"), pa.array([h[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()), pa.array(swaps, pa.list_(pa.int32()))],
                names=["toxic", "features", "swaps"],
            )


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label, in the batches of a task."""
    for batch in batches:
        label = batch.column("toxic").to_numpy(zero_copy_only=False)
        raw = [x.as_py() for x in batch.column("features")]
        for kind in (0, 1):
            mine = np.frombuffer(b"".join(r for r, k in zip(raw, label) if k == kind), dtype=U64)
            found, n = np.unique(mine, return_counts=True)
            n0, n1 = (n, np.zeros_like(n)) if kind == 0 else (np.zeros_like(n), n)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(n0), pa.array(n1)], names=["hash", "n0", "n1"])


def separating_features(sample: DataFrame, toxic: int, other: int) -> np.ndarray:
    """The FEATURES hashes whose rates of presence among ``toxic`` and ``other``
    sample documents lie the most standard errors apart, at least LEAST_Z; not
    identity terms. Counted by Spark, so the driver sees the chosen ones only,
    however long the sampled texts are."""
    known, _ = identity_hashes()
    counts = sample.mapInArrow(_feature_counts, "hash long, n0 long, n1 long").groupBy("hash").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p1, p0 = (F.col("n1") + 0.5) / (toxic + 1), (F.col("n0") + 0.5) / (other + 1)
    p = (F.col("n0") + F.col("n1")) / (toxic + other)
    z = F.abs((p1 - p0) / F.sqrt(p * (1 - p) * (1 / toxic + 1 / other) + 1e-12))
    strong = counts.withColumn("z", z).where((F.col("z") >= LEAST_Z) & (F.col("n0") + F.col("n1") >= 3) & ~F.col("hash").isin(known.view(np.int64).tolist()))
    chosen = strong.orderBy(F.desc("z"), "hash").limit(FEATURES).select("hash").collect()
    return np.array([r.hash for r in chosen], dtype=np.int64).view(U64)


def _hits(hashes: np.ndarray):
    """The places in ``hashes`` of the features of each sample text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [np.flatnonzero(np.isin(hashes, np.frombuffer(x.as_py(), dtype=U64))).astype(np.int32) for x in batch.column("features")]
            yield pa.record_batch([batch.column("toxic"), pa.array(hits, pa.list_(pa.int32())), batch.column("swaps")], names=["toxic", "hits", "swaps"])

    return run


def held_out(id_col: str | Column) -> Column:
    """Rows that no model is fitted on: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC, sample_other: int = SAMPLE_OTHER
) -> ToxicityModel:
    """Fit on labelled documents outside the held-out fold. The sample is the
    first ``sample_toxic`` toxic and ``sample_other`` other labels in the order of
    a hash of their ids (a fixed bound; all documents are scored). Labels that are
    null or neither 0 nor 1, and ids without a document, are ignored. Without both
    kinds of labels every text gets the share of toxic ones (0.5 without any)."""
    small_batches(docs.sparkSession)
    known, _ = identity_hashes()
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(F.col("toxic").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id"))
    totals = {r.toxic: r[1] for r in usable.groupBy("toxic").count().collect()}
    picked = None
    for kind, bound in ((1, sample_toxic), (0, sample_other)):
        some = usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("label_id"), "label_id").limit(bound)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).join(
        F.broadcast(picked), F.col("id") == F.col("label_id")
    )
    with Scratch(docs.sparkSession) as keep:
        sample = keep(texts.select("toxic", "text").mapInArrow(_sample_features, "toxic int, features binary, swaps array<int>"), "sample")
        by_label = {r.toxic: r[1] for r in sample.groupBy("toxic").count().collect()}
        toxic, other = by_label.get(1, 0), by_label.get(0, 0)
        if not toxic or not other:
            rate = (toxic + 0.5) / (toxic + other + 1)
            return ToxicityModel(float(np.log(rate / (1 - rate))), np.zeros(0, U64), np.zeros(0))
        hashes = np.unique(np.concatenate((separating_features(sample, toxic, other), known)))
        rows = sample.mapInArrow(_hits(hashes), "toxic int, hits array<int>, swaps array<int>").collect()
    y = np.array([r.toxic for r in rows], dtype=float)
    x = np.zeros((len(rows), len(hashes)), dtype=np.float64)
    for i, r in enumerate(rows):
        x[i, r.hits] = 1
    # The loss counts each sampled row for the labels of its kind that it stands for.
    share = {1: totals.get(1, 0) / toxic, 0: totals.get(0, 0) / other}
    weight = np.array([share[int(v)] for v in y])
    weight /= weight.mean()
    penalty = RIDGE * np.eye(len(hashes) + 1)
    penalty[0, 0] = 0
    place = np.searchsorted(hashes, known) + 1
    for r in rows:
        for s in r.swaps:
            a, b = place[s // len(known)], place[s % len(known)]
            penalty[[a, b], [a, b]] += SWAP_WEIGHT
            penalty[[a, b], [b, a]] -= SWAP_WEIGHT
    w = fit(x, y, weight, penalty)
    return ToxicityModel(float(w[0]), hashes, w[1:])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 for every whole text (likelier toxic
    the higher). Null and empty texts get the score of a text without any feature;
    texts of any length count whole, equal texts get equal scores. Rows may repeat; a
    column named ``name`` is replaced; an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, model.score_column()(F.col(text_col)))


def keep_civil(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, unchanged and as often as they occur, whose score is
    below ``threshold`` (see :func:`toxicity_scores`), with all their columns."""
    small_batches(docs.sparkSession)
    return docs.where(model.score_column()(F.col(text_col)) < threshold)
