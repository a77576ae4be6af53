"""The registered queries: those with SQL against it, the others by their columns."""

import pytest

import __spark_entry__ as entry
from calltide.llm import queries
from tests.compare import connect, difference

COLUMNS = {
    "op1_token_counts": {"doc_id", "n_tokens"},
    "op2_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op3_mix_sources": {"doc_id", "size", "source_size", "target", "taken"},
    "op5_decontamination": {"doc_id", "contaminated"},
    "op6_token_binary": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op9_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), name, sf_dir) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_every_document(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    assert COLUMNS[name] <= set(got.columns)
    assert got.count() == queries.table(spark, sf_dir, "documents").count()


def test_all_are_registered():
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries()) and len(queries.QUERIES) == 13
