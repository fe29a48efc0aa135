"""Driver contract: entry() and a sample of queries against their DuckDB oracle."""

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_returns_recommendations(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 3
    assert "recommendation_reason" in df.columns


def test_every_query_has_an_oracle():
    """The llm operators that SQL cannot express are held against brute force in tests/llm."""
    llm = {n for n in E.queries() if n == "pipeline" or n.startswith("op") and n[2:].split("_")[0].isdigit()}
    assert set(E.queries()) - llm == set(E.oracle_sql()) - llm
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["recommendations_region", "candidates", "current_schedule", "latest_booking",
                                  "rescued_rows", "stream_ingest", "dq_audit", "dq_gate", "band_pairs"])
def test_query_matches_oracle(spark, name):
    r = compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
    assert r["columns_match"], (r["spark_cols"], r["duck_cols"])
    assert r["ok"], r["rows"]
