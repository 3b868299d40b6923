"""The driver contract, and a sample of the registered queries against their oracles."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracles import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "g06_impact_analysis", "g09_closure_table", "s01_run_event_source", "s22_subgraph_diagram", "p01_node_upsert", "p16_script_tables", "c05_column_provenance",
    "j08_validity_interval_join", "a11_column_metrics", "a15_service_levels", "w02_z_score_anomaly", "w08_feature_windows", "u04_schema_drift", "q03_trust_score",
    "v15_pii_in_text", "f04_affected_domains", "m10_chunking", "v16_source_attribution", "w09_retrieval_ranking", "t01_windowed_aggregate", "t10_change_upsert_sink"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()) if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_query_equals_oracle(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        assert len(got)
        return
    want = duck.execute(oracle).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
