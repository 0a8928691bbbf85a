"""Document quality by hierarchical empirical Bayes.

A logistic model on the shape of the text (word and line lengths, capitals,
symbols, repetition) gives each document its own evidence. The documents of a
host, and of a path within it, give evidence about the site: the mean of their
probabilities, by grouped aggregation. A path's mean is shrunk towards its
host's and a host's towards the mean of all documents, the more the fewer
documents it has; the strength of shrinkage is estimated from the spread of
the group means (method of moments). The posterior log odds of a document are
its own plus the site's surplus over the mean of all, times a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.logistic import fit, sigmoid
from cabgrid.llm.scratch import saved, small_batches
from cabgrid.llm.toxicity import held_out

#: Labelled documents to fit on, at most.
SAMPLE = 20_000
RIDGE = 0.1
#: Weight of the site's surplus log odds beside the document's own.
SITE_WEIGHT = 0.5
#: Documents whose posterior quality is below this are rejected.
REJECT_BELOW = 0.3
#: Sites whose table may be sent to all tasks; more are joined by a shuffle.
SEND_SITES = 100_000
SLICE_BYTES = 512 << 10
SHAPE = 16


def shapes(column: pa.Array) -> np.ndarray:
    """SHAPE numbers for each text, all bounded; zeros for one without words."""
    data, offs = tx.string_bytes(column)
    n = len(offs) - 1
    starts, ends, first = tx.find_words(data, offs)
    out = np.zeros((n, SHAPE))
    if len(starts) == 0:
        return out
    size = np.diff(offs).astype(float)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    of_word = np.repeat(np.arange(n), np.diff(first))

    def count(mask: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(mask)
        return np.diff(np.searchsorted(at, offs)).astype(float)

    low = tx.lower_ascii(data)
    letters = ((low - np.uint8(97)) < 26) | (data >= 128)
    capital = (data - np.uint8(65)) < 26
    mark = (data == 46) | (data == 44) | (data == 59) | (data == 58) | (data == 63) | (data == 39)
    symbol = ~letters & ~mark & (data > 32) & ~((data - np.uint8(48)) < 10)
    hashes = tx.hash_spans(low, starts, ends)
    order = np.lexsort((hashes, of_word))
    h, d = hashes[order], of_word[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    begin = np.flatnonzero(new)
    times = np.diff(begin, append=len(h))
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    length = (ends - starts).astype(float)
    capital_before = np.concatenate(([0], np.cumsum(capital)))
    shouted = (capital_before[ends] - capital_before[starts]) * 2 > length
    lines = count(data == 10) + 1
    most = np.zeros(n)
    np.maximum.at(most, d[begin], times)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, weights=values, minlength=n) / some

    out[:, 0] = np.log1p(words) / 10
    out[:, 1] = np.minimum(mean(length), 40) / 10
    out[:, 2] = np.minimum(np.sqrt(np.maximum(mean(length**2) - mean(length) ** 2, 0)), 40) / 10
    out[:, 3] = count(letters) / np.maximum(size, 1)
    out[:, 4] = count(capital) / np.maximum(size, 1) * 4
    out[:, 5] = mean(shouted)
    out[:, 6] = np.minimum(count(symbol) / some, 4)
    out[:, 7] = np.minimum(count(data == 124) / some, 1)
    out[:, 8] = np.minimum(count(mark) / some, 2)
    out[:, 9] = np.bincount(d[begin], minlength=n) / some
    out[:, 10] = most / some
    out[:, 11] = mean(same)
    out[:, 12] = np.minimum(np.log1p(words / lines), 6) / 2
    out[:, 13] = np.minimum(count((data - np.uint8(48)) < 10) / some, 2)
    out[:, 14] = np.minimum(count(data == 33) / some, 2)
    out[:, 15] = words < 20
    out[words == 0] = 0
    return out


@dataclass(frozen=True)
class QualityModel:
    """Weights of a logistic model over standardised shapes, intercept first."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def probability(self, shape: np.ndarray) -> np.ndarray:
        z = np.clip((shape - self.centre) / self.spread, -8, 8)
        return sigmoid(self.weights[0] + z @ self.weights[1:])

    def probability_column(self):
        """An Arrow UDF from text to the probability of good quality."""

        @F.arrow_udf("double")
        def probability(column: pa.Array) -> pa.Array:
            batch = pa.record_batch([column], names=["text"])
            parts = [self.probability(shapes(p.column("text"))) for p in tx.slices(batch, "text", SLICE_BYTES)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

        return probability


def _sample_shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tx.slices(batch, "text", SLICE_BYTES):
            flat = shapes(part.column("text")).reshape(-1)
            at = pa.array(np.arange(part.num_rows + 1) * SHAPE, pa.int32())
            yield pa.record_batch([part.column("quality"), pa.ListArray.from_arrays(at, pa.array(flat))], names=["quality", "shape"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit on the first ``sample`` labels, in the order of a hash of their ids,
    that aren't held out (a fixed bound; all documents are scored). Labels that
    are null or neither 0 nor 1, and ids without a document, are ignored. Without
    both kinds of labels every text gets the share of good ones (0.5 without any)."""
    small_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id"))
    picked = usable.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).join(
        F.broadcast(picked), F.col("id") == F.col("label_id")
    )
    rows = texts.select("quality", "text").mapInArrow(_sample_shapes, "quality int, shape array<double>").collect()
    y = np.array([r.quality for r in rows], dtype=float)
    if len(rows) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return QualityModel(np.zeros(SHAPE), np.ones(SHAPE), np.concatenate(([np.log(rate / (1 - rate))], np.zeros(SHAPE))))
    x = np.array([r.shape for r in rows])
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    penalty = RIDGE * np.eye(SHAPE + 1)
    penalty[0, 0] = 0
    return QualityModel(centre, spread, fit(np.clip((x - centre) / spread, -8, 8), y, np.ones(len(y)), penalty))


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame) -> float:
    """Pseudo-documents of the prior: how many documents a group needs before its
    own mean counts for half, between 1 and 10,000. The variance of group means
    around their parent's mean (``centre``), beyond what the documents' variance
    within groups explains, by the method of moments for groups of unequal size:
    E[sum n (mean - centre)^2] = sum(1 - n/N) within + sum(n - n^2/N) between, with
    N the documents of the parent (``parent_n``)."""
    n, mean = F.col("n"), F.col("total") / F.col("n")
    got = groups.agg(
        F.sum(n - 1).alias("free"),
        F.sum(F.col("square") - F.col("total") * mean).alias("within"),
        F.sum(n * (mean - F.col("centre")) ** 2).alias("between"),
        F.sum(1 - n / F.col("parent_n")).alias("groups"),
        F.sum(n - n * n / F.col("parent_n")).alias("weight"),
    ).first()
    if not got.free or got.free <= 0 or got.weight < 1e-9:
        return 100.0
    within = max(got.within, 0.0) / got.free
    between = max((got.between - got.groups * within) / got.weight, 0.0)
    return float(min(max(within / between, 1.0), 10_000.0)) if between > 0 else 10_000.0


def site_table(scored: DataFrame, site_weight: float = SITE_WEIGHT) -> DataFrame:
    """(``host``, ``path``, ``p_host``, ``p_path``, ``surplus``) from rows of
    (``host``, ``path``, ``p``): posterior means of every site and what it adds to
    the log odds of its documents. Hosts are shrunk toward the mean of all
    documents, paths toward their host, each as far as their own spread around
    that (:func:`_strength`) doesn't speak for them."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("square"))
    paths = saved(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square"))
    n, total = hosts.agg(F.sum("n"), F.sum("total")).first()
    mean = total / n if n else 0.5
    k_host = _strength(hosts.withColumns({"centre": F.lit(mean), "parent_n": F.lit(n)}))
    parents = hosts.select(
        F.col("host").alias("of_host"),
        F.col("n").alias("parent_n"),
        (F.col("total") / F.col("n")).alias("centre"),
        ((F.col("total") + k_host * mean) / (F.col("n") + k_host)).alias("p_host"),
    )
    both = paths.join(parents, F.col("host").eqNullSafe(F.col("of_host")))
    k_path = _strength(both)
    p_path = (F.col("total") + k_path * F.col("p_host")) / (F.col("n") + k_path)
    return both.select("host", "path", "p_host", p_path.alias("p_path")).withColumn(
        "surplus", site_weight * (_logit(F.col("p_path")) - _logit(F.lit(mean)))
    )


def _judged(docs: DataFrame, model: QualityModel, host: str | Column, path: str | Column, text_col: str, site_weight: float) -> DataFrame:
    """``row`` (all columns as a struct) with the evidence and the posterior."""
    small_batches(docs.sparkSession)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    score = model.probability_column()(F.col(text_col))
    sites = saved(site_table(docs.select(as_column(host).alias("host"), as_column(path).alias("path"), score.alias("p")), site_weight), "sites")
    few = sites.limit(SEND_SITES + 1).count() <= SEND_SITES
    rows = docs.select(F.struct("*").alias("row"), as_column(host).alias("own_host"), as_column(path).alias("own_path"), score.alias("p"))
    joined = rows.join(
        F.broadcast(sites) if few else sites,
        F.col("own_host").eqNullSafe(F.col("host")) & F.col("own_path").eqNullSafe(F.col("path")),
    )
    return joined.select("row", "p", "p_host", "p_path", (1 / (1 + F.exp(-(_logit(F.col("p")) + F.col("surplus"))))).alias("quality"))


def quality_posteriors(
    docs: DataFrame,
    model: QualityModel,
    host: str | Column = "source",
    path: str | Column = "lang",
    text_col: str = "text",
    site_weight: float = SITE_WEIGHT,
) -> DataFrame:
    """``docs`` with ``p_document``, ``p_host``, ``p_path`` and ``quality`` (the
    posterior probability), whatever columns it has (these four replace columns
    of their names).

    Null hosts and paths are sites like others. Texts of any length count whole,
    and rows that repeat are documents like others. A null text or one without words
    has the shape of all zeros. Equal texts of one site get equal posteriors; an
    empty table gives an empty result. The text isn't shuffled while there are at
    most SEND_SITES sites: their table is then sent to all tasks."""
    judged = _judged(docs, model, host, path, text_col, site_weight)
    made = {"p_document": "p", "p_host": "p_host", "p_path": "p_path", "quality": "quality"}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in made]
    return judged.select(*kept, *[F.col(c).alias(name) for name, c in made.items()])


def keep_good(
    docs: DataFrame,
    model: QualityModel,
    host: str | Column = "source",
    path: str | Column = "lang",
    text_col: str = "text",
    site_weight: float = SITE_WEIGHT,
    reject_below: float = REJECT_BELOW,
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose posterior isn't below ``reject_below``
    (see :func:`quality_posteriors`)."""
    judged = _judged(docs, model, host, path, text_col, site_weight)
    return judged.where(F.col("quality") >= reject_below).select("row.*")
