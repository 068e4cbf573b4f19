"""Queries with a SQL twin against it, the others over the same whole tables."""

import duckdb
import pytest

from docloom.llm.queries import ORACLES, QUERIES
from tests.check import rows_of

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": "doc_id held_out lang_pred score",
    "op3_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op4_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op5_jaccard_join": "doc_id n_shingles component_id",
    "op6_toxicity_svm": "doc_id held_out score predicted",
    "op8_bpe_codec": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_pii_boosting": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", list(COLUMNS))
def test_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == list(range(200))
