"""Driver contract: entry() runs, and queries() agree with oracle_sql() in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "rank"]
    assert len(rows) == 210
    assert sum(r["rank"] for r in rows) == pytest.approx(1.0, abs=1e-8)


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) == set(entry._oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


FAST = [
    "vertices",
    "vertex_count",
    "vertex_index",
    "indexed_edges",
    "out_degree",
    "edges_with_out_degree",
    "transition_matrix",
    "transition_matrix_collapsed",
    "initial_vector",
    "multiply_once",
    "vector_sum",
    "redistributed_vector",
    "l1_distance",
    "block_assignment",
    "block_matrix",
    "unblocked_matrix",
    "rank_cluster",
    "rank_history",
    "event_flow_edges",
    "read_write_roundtrip",
    "edges_read_report",
    "rank_step_prepared",
]


def test_queries_match_oracle(spark):
    report = compare(spark, SF, FAST)
    bad = {k: v for k, v in report.items() if not v.get("values_match")}
    assert not bad, bad


def test_redistributed_vector_is_computed_once(spark):
    """The sum and the result read one product; nothing below it is computed again."""
    result = entry.q_redistributed_vector(spark, SF)
    read = result._jdf.queryExecution().optimizedPlan().children().head()
    assert read.getClass().getSimpleName() == "InMemoryRelation" and result.count() == 210
    spark.catalog.clearCache()


def test_vertex_count_deals_lines_by_their_number(spark, monkeypatch):
    """6,000 lines, at most 1,000 a task, go to six tasks under any number of shuffle partitions."""
    assert entry.q_vertex_count(spark, SF).collect()[0]["n"] == (expected := entry.GRAPHS["cust_part"](spark, SF).select("src").distinct().count())
    monkeypatch.setattr(entry.tables, "LINES_PER_TASK", 1000, raising=False)
    dealt = entry.q_vertex_count(spark, SF)
    assert dealt.collect()[0]["n"] == expected
    assert "RepartitionByExpression [l_orderkey" in dealt._jdf.queryExecution().analyzed().toString()
