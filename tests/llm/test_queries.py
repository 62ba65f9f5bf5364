import os

import duckdb
import pytest

from logloom.llm import oracle, queries
from tests.llm.conftest import SF
from tools.oracle_check import TABLES, digest

COLUMNS = {
    "op1_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op2_simhash": {"doc_id", "fingerprint", "component_id"},
    "op3_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op6_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op7_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op10_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op11_hard_negatives": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    "op12_nnls_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op13_ranked_search": {"item_id", "rank", "doc_id", "score"},
}


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(oracle.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    assert set(queries.QUERIES[name](spark, SF).columns) == COLUMNS[name]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 1 + len(queries.QUERIES)))
