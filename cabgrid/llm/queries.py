"""The numbered corpus queries: ``(spark, table_dir) -> DataFrame``. Each
applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabgrid.llm import oracles
from cabgrid.llm.byte_bpe import read_tokenizer
from cabgrid.llm.ctph import edited_neighbours
from cabgrid.llm.filter_audit import filter_audit
from cabgrid.llm.gridcodes import fit_codebooks, vector_codes
from cabgrid.llm.html_text import extract_main_text
from cabgrid.llm.packing import pack
from cabgrid.llm.quality import REJECT_BELOW, fit_quality, quality_posteriors
from cabgrid.llm.sharding import balanced_shards
from cabgrid.llm.spm import encoded, read_model
from cabgrid.llm.substrings import remove_repeats
from cabgrid.llm.superminhash import near_duplicates
from cabgrid.llm.topk import top_k
from cabgrid.llm.toxicity import THRESHOLD, fit_toxicity, held_out, toxicity_scores
from cabgrid.llm.vector_packing import pack_examples

#: Public vocabularies; a cluster names its own copies.
SPM_PATH = "/opt/tokenizers/piece_bpe_32k.model"
TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{table_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, table_dir: str) -> DataFrame:
    """Toxicity score of every text of ``documents``."""
    docs, labels = (table(spark, table_dir, t) for t in ("documents", "labels"))
    scored = toxicity_scores(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op2_top_k(spark: SparkSession, table_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth of ``embeddings``."""
    vectors = table(spark, table_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, scale=1024)


def op3_near_dedup(spark: SparkSession, table_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``: 4-word shingles, Jaccard >= 0.8."""
    return near_duplicates(table(spark, table_dir, "documents"), shingle=4, percent=80)


def op4_quality(spark: SparkSession, table_dir: str) -> DataFrame:
    """Posterior quality of every text of ``documents``; host: source, path: language."""
    docs, labels = (table(spark, table_dir, t) for t in ("documents", "labels"))
    scored = quality_posteriors(docs.select("doc_id", "text", "source", "lang"), fit_quality(docs, labels))
    return scored.select(
        "doc_id", "source", "lang", "p_document", "p_host", "p_path", "quality", (F.col("quality") >= REJECT_BELOW).alias("kept")
    )


def op5_substring_dedup(spark: SparkSession, table_dir: str) -> DataFrame:
    """``documents`` without words of 13-word windows that an earlier document has."""
    cut = remove_repeats(table(spark, table_dir, "documents"), window=13, layout=False)
    return cut.select("source_row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_sentencepiece(spark: SparkSession, table_dir: str, model_path: str = SPM_PATH) -> DataFrame:
    """Ids of every text of ``documents``, as a count and a digest, with checks."""
    done = encoded(table(spark, table_dir, "documents"), read_model(model_path))
    return done.select("doc_id", "n_tokens", "n_byte_tokens", F.sha2("ids", 256).alias("ids_sha256"), "round_trip", "parity")


def op7_main_text(spark: SparkSession, table_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    done = extract_main_text(table(spark, table_dir, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_packing(spark: SparkSession, table_dir: str) -> DataFrame:
    """``documents`` in bins of 2,048 words, no two of one source or text in a bin."""
    return pack(table(spark, table_dir, "documents"))


def op9_sharding(spark: SparkSession, table_dir: str) -> DataFrame:
    """``documents`` in eight shards of near equal bytes, equal texts together."""
    done = balanced_shards(table(spark, table_dir, "documents"), shards=8)
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_fingerprints(spark: SparkSession, table_dir: str) -> DataFrame:
    """Piecewise fingerprints of ``documents``, their edited texts and neighbours."""
    return edited_neighbours(table(spark, table_dir, "documents"))


def op11_vector_codes(spark: SparkSession, table_dir: str) -> DataFrame:
    """Codes of ``embeddings``: 8 parts, codebooks of 16 entries, 6 rounds."""
    vectors = table(spark, table_dir, "embeddings")
    books = fit_codebooks(vectors)
    return vector_codes(vectors, books).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    )


def op12_filter_audit(spark: SparkSession, table_dir: str) -> DataFrame:
    """What five filters remove from ``documents`` in each of their 120 orders."""
    return filter_audit(*(table(spark, table_dir, t) for t in ("documents", "labels")))


def op13_sequences(spark: SparkSession, table_dir: str, tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """``documents`` in sequences of 2,048 ids, 256 pieces and 2,048 ids that bear loss (all do)."""
    packed = pack_examples(table(spark, table_dir, "documents"), read_tokenizer(tokenizer_path))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_top_k": op2_top_k,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_main_text": op7_main_text,
    "op8_packing": op8_packing,
    "op9_sharding": op9_sharding,
    "op10_fingerprints": op10_fingerprints,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_sequences": op13_sequences,
}

ORACLE_SQL: dict[str, str] = {
    "op2_top_k": oracles.TOP_K,
    "op3_near_dedup": oracles.NEAR_DEDUP,
    "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_vector_codes": oracles.VECTOR_CODES,
    "op12_filter_audit": oracles.FILTER_AUDIT,
}
