"""Physical plan of a rank step: one shuffle, constant size, no scan of unused columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surfrank.plans.layout import LinkMatrix
from surfrank.plans.rank import next_vector, start_vector
from surfrank.session import scoped_conf
from surfrank.sources import tables

SF = "/root/testdata/sf0.001"


def _nodes(df) -> list[str]:
    """Node names of the executed plan.  Cached relations are leaves here: their
    own plan was run once when the matrix was built, not in every step."""
    names, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        names.append(node.nodeName())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return names


@pytest.mark.parametrize("hot_min_rows", [10_000, 1])
def test_one_shuffle_per_step_and_constant_plan(spark, hot_min_rows):
    edges = tables.cust_part(spark, SF)
    lm = LinkMatrix.build(edges, num_partitions=4, strategy="partitioned", hot_min_rows=hot_min_rows, max_hot=1000)
    assert (lm.hot is not None) == (hot_min_rows == 1)
    try:
        with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(lm.num_partitions)}):
            vec = start_vector(lm, None)
            sizes = []
            for _ in range(3):
                # as the loop does it: cache, lazy checkpoint, one aggregation, uncache
                raw = next_vector(lm, vec, 0.2, 0.0).persist()
                nxt = raw.checkpoint(eager=False)
                nxt.agg(F.sum("rank")).collect()
                raw.unpersist()
                vec = nxt.select("id", "rank", "sink")
                plan = next_vector(lm, vec, 0.2, 0.0)
                nodes = _nodes(plan)
                sizes.append(len(nodes))
                # the partial-sum shuffle is the only exchange; matrix and previous
                # vector are merged in place (hubs: bounded broadcasts)
                assert nodes.count("Exchange") == 1, nodes
                assert nodes.count("SortMergeJoin") == 2 and "ShuffledHashJoin" not in nodes
                assert nodes.count("BroadcastExchange") == (0 if lm.hot is None else 2)
                # below the exchange there are only sums per target, no vector rows
                text = plan._jdf.queryExecution().executedPlan().toString()
                below = text[text.index("Exchange hashpartitioning") :]
                assert "partial_sum" in below.splitlines()[1] and "sink" not in below.split("SortMergeJoin")[0]
                # every matrix part is read from the cache, not from its checkpoint files
                assert nodes.count("InMemoryTableScan") == (1 if lm.hot is None else 2)
            assert len(set(sizes)) == 1
    finally:
        lm.unpersist()


def test_edge_scan_is_pruned(spark):
    plan = tables.part_supp(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_scoped_conf_restores(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
