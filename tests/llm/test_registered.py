"""The registered queries: SQL where there is some, and the shape of all."""

import cases
import oracle
import pytest

import __spark_entry__ as entry
from ledgerloom.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_mix": "doc_id size source_size target taken",
    "op3_urls": "page_id host path rule verdict",
    "op4_language": "doc_id held_out lang_pred score",
    "op5_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op6_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7_pii": "doc_id text text_sha256",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_tokens": "doc_id n_words n_tokens",
    "op11_dialogue": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_lines": "doc_id n_lines n_dropped kept_sha256",
    "op13_phrases": "lang rank phrase a l r n score",
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries() and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_columns(spark, name):
    df = QUERIES[name](spark, cases.SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    df = QUERIES[name](spark, cases.SF)
    rows = [tuple(row) for row in df.collect()]
    cursor = oracle.connect(cases.SF).execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert oracle.compare(df.columns, rows, columns, cursor.fetchall()) == ""
