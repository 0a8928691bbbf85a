"""A corpus pipeline over ``documents``: toxicity, quality, near duplicates,
repeated passages, packing. Each stage takes what the one before it kept,
written as a table and read again; all but the last return the columns of
``documents``.

In every stage: other columns pass unchanged, whatever their names; an empty table
gives an empty one; texts of any length are read whole; rows that repeat are
documents of their own unless a stage says otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabgrid.llm.packing import pack
from cabgrid.llm.quality import fit_quality, keep_good
from cabgrid.llm.queries import table
from cabgrid.llm.scratch import saved
from cabgrid.llm.substrings import remove_repeats
from cabgrid.llm.superminhash import keep_one
from cabgrid.llm.toxicity import fit_toxicity, keep_civil

#: Words of a passage that is removed where an earlier document has it too.
PASSAGE_WORDS = 50


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go. Null and empty texts get
    the score of a text without any feature; equal texts fare alike."""
    return keep_civil(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is too low go. A null or empty text is
    judged by a shape of zeros and its site; null sources and languages are sites."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least
    id. Texts without words are in no group; rows with a null id stay, and of rows
    with one id one does."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE_WORDS words or more that an earlier document has are cut.
    Earlier: with a smaller id; rows of one id don't cut each other. A null text and
    a row with a null id stay as they are."""
    cut = remove_repeats(docs, window=PASSAGE_WORDS, layout=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text"))
    made = {
        "text": F.when(F.col("text_is_null"), F.lit(None)).otherwise(F.col("kept_text")),
        "n_chars": F.when(text.isNotNull(), F.length(text).cast("long")).otherwise(F.col("source_row.n_chars")),
    }
    return cut.select(*[(made[c] if c in made else F.col(f"source_row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the bin of each; a null text or one without words
    is one piece in no bin."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: The classifiers can't be expressed in SQL; the tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
