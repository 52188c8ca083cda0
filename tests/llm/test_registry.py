"""Every registered query runs on the small tables and returns its contract's
columns; the operator texts of the fixtures are those of the tables."""

import pytest

import __spark_entry__ as E

COLUMNS = {
    "op1_decontaminate": {"doc_id", "item_id", "coverage"},
    "op2_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op4_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_licenses": {"doc_id", "license", "rule", "n_matches"},
    "op6_substrings": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7_nearest": {"query_id", "rank", "vec_id", "score"},
    "op8_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op9_katz": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op10_simhash": {"doc_id", "fingerprint", "component_id"},
    "op11_repetition": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept"},
    "op12_phrases": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op13_hard_negatives": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
}


def test_all_are_registered():
    assert set(COLUMNS) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_its_columns(spark, sf_small, name):
    got = E.queries()[name](spark, sf_small)
    assert COLUMNS[name] <= set(got.columns)
    assert got.count() > 0
