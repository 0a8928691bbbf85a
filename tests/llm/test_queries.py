"""The registered corpus queries: SQL where there is some, else their contract."""

import zlib

import pytest

import __spark_entry__ as entry
from cabgrid.llm.queries import ORACLE_SQL, QUERIES
from conftest import SF001, SF01
from oracle_compare import compare

COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_top_k": ["query_id", "rank", "vec_id", "score"],
    "op3_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_quality": ["doc_id", "source", "lang", "p_document", "p_host", "p_path", "quality", "kept"],
    "op5_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op6_sentencepiece": ["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip", "parity"],
    "op7_main_text": ["page_id", "url", "text", "n_chars"],
    "op8_packing": ["doc_id", "piece", "first_word", "n_words", "bin", "bin_offset"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op11_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op12_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op13_sequences": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_has_its_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SF001)
    assert got.columns == COLUMNS[name]
    table = {"op2_top_k": None, "op13_sequences": None, "op12_filter_audit": None, "op11_vector_codes": "embeddings", "op7_main_text": "pages", "op8_packing": None}.get(name, "documents")
    if table:
        assert got.count() == spark.read.parquet(f"{SF001}/{table}.parquet").count()


def test_toxicity_folds(spark):
    for r in QUERIES["op1_toxicity"](spark, SF001).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)


def test_main_text_equals_the_articles_of_the_synthetic_pages(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    for r in QUERIES["op7_main_text"](spark, SF01).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)).split() for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == " ".join(" ".join(b) for b in blocks if b) and r.n_chars == len(r.text)


def test_sentencepiece_agrees_everywhere(spark):
    rows = QUERIES["op6_sentencepiece"](spark, SF01).collect()
    assert all(r.round_trip and r.parity for r in rows)
