"""Single operators: reader, vertices, degrees, index, matrix, vector, blocks, skew helpers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import surfrank as sr
from surfrank.functions.sequence import with_next
from surfrank.functions.skew import split_join


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.tsv"), "w") as f:
        f.write(text)
    return path


READER_TEXT = "# comment\na\tb\n\nc\ta\n1\t2\textra\n"


def test_reader_cases(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "g"), READER_TEXT)
    got = sorted(tuple(r) for r in sr.read_edges(spark, path).collect())
    assert got == [("1", "2"), ("a", "b"), ("c", "a")]


def test_reader_comment_only_at_line_start(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "g"), "b\tc # x\n #d\te\n")
    got = sorted(tuple(r) for r in sr.read_edges(spark, path).collect())
    assert got == [(" #d", "e"), ("b", "c # x")]


def test_reader_malformed(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "g"), "a\tb\nq\n")
    with pytest.raises(Exception, match="malformed"):
        sr.read_edges(spark, path).collect()
    got = [tuple(r) for r in sr.read_edges(spark, path, on_malformed="drop").collect()]
    assert got == [("a", "b")]


def test_reader_id_types(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "g"), "01\t1\n")
    text = sr.read_edges(spark, path)
    assert sr.count_vertices(text) == 2
    longs = sr.read_edges(spark, path, id_type="long")
    assert [tuple(r) for r in longs.collect()] == [(1, 1)]
    assert sr.count_vertices(longs) == 1
    bad = _write(os.path.join(tmp_dir, "bad"), "x\t1\n")
    with pytest.raises(Exception, match="64-bit"):
        sr.read_edges(spark, bad, id_type="long").collect()


def test_missing_input(spark, tmp_dir):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        sr.read_edges(spark, os.path.join(tmp_dir, "nope")).collect()


def test_write_read_roundtrip(spark, edges_of, tmp_dir):
    edges = edges_of("a>b c>a a>b")
    note = spark.createDataFrame([("# header", "-")], "src string, dst string")
    path = os.path.join(tmp_dir, "out")
    sr.write_edges(note.unionByName(edges), path)
    back = sorted(tuple(r) for r in sr.read_edges(spark, path).collect())
    assert back == sorted(tuple(r) for r in edges.collect())


def test_write_ranks_text_and_parquet(spark, edges_of, tmp_dir):
    res = sr.rank(edges_of("a>b a>c b>c"), preset="script")
    sr.write_ranks(res.ranks, os.path.join(tmp_dir, "txt"), ordered=True, single_file=True)
    files = [f for f in os.listdir(os.path.join(tmp_dir, "txt")) if f.startswith("part-")]
    lines = open(os.path.join(tmp_dir, "txt", files[0])).read().splitlines()
    assert [ln.split("\t")[0] for ln in lines] == ["a", "b", "c"]
    sr.write_ranks(res.ranks, os.path.join(tmp_dir, "pq"), fmt="parquet")
    back = sr.read_vector(spark, os.path.join(tmp_dir, "pq"))
    assert sorted(back.collect()) == sorted(res.ranks.collect())


def test_vertices_and_degrees(spark, edges_of):
    edges = edges_of("a>b a>b a>c b>b b>c c>a c>d")
    assert sorted(r.id for r in sr.vertices(edges).collect()) == ["a", "b", "c", "d"]
    assert sr.vertex_count(edges).collect()[0]["n"] == 4
    deg = {r.src: r.out_degree for r in sr.out_degree(edges).collect()}
    assert deg == {"a": 3, "b": 2, "c": 2}
    table = {r.id: r.out_degree for r in sr.vertex_table(edges).collect()}
    assert table == {"a": 3, "b": 2, "c": 2, "d": 0}
    rows = sr.with_out_degree(edges, max_hot=1).collect()
    assert len(rows) == 7 and all(r.out_degree == deg[r.src] for r in rows)


def test_vertex_index_dense_and_ordered(spark):
    ids = spark.range(0, 500).select((F.col("id") * 7 % 1000).cast("string").alias("src"))
    edges = ids.select("src", F.lit("zz").alias("dst"))
    index = sr.vertex_index(edges, num_partitions=6).collect()
    by_id = sorted(index, key=lambda r: r.id)
    assert [r.idx for r in by_id] == list(range(len(by_id)))


def test_index_decode_roundtrip(spark, edges_of):
    edges = edges_of("a>b a>b a>c b>b b>c c>a c>d")
    index = sr.vertex_index(edges)
    dense = sr.index_edges(edges, index, max_hot=1)
    assert dense.count() == 7
    vec = index.select("idx", (F.col("idx") * 1.0).alias("rank"))
    decoded = {r.id: r.rank for r in sr.decode_vector(vec, index).collect()}
    assert decoded == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_lookup(spark, edges_of):
    res = sr.rank(edges_of("a>b a>c b>c"), preset="script")
    ids = spark.createDataFrame([("a",), ("c",), ("zz",)], "id string")
    got = {r.id: r.rank for r in sr.lookup(res.ranks, ids).collect()}
    assert set(got) == {"a", "c"} and got["a"] == pytest.approx(0.20324996, abs=2e-9)


def test_transition_matrix_collapse(spark, edges_of):
    edges = edges_of("a>b a>b a>c b>b b>c c>a c>d")
    full = sr.transition_matrix(edges, collapse=False).collect()
    assert len(full) == 7
    summed = {}
    for r in full:
        summed[(r.src, r.dst)] = summed.get((r.src, r.dst), 0) + r.w
    collapsed = {(r.src, r.dst): r.w for r in sr.transition_matrix(edges, collapse=True, max_hot=1).collect()}
    assert collapsed.keys() == summed.keys()
    for k in summed:
        assert collapsed[k] == pytest.approx(summed[k], abs=1e-15)
    assert collapsed[("a", "b")] == pytest.approx(2 / 3)


def test_vector_operators(spark, edges_of):
    edges = edges_of("a>b a>c b>c")
    verts = sr.vertices(edges)
    m = sr.transition_matrix(edges)
    v0 = sr.initial_vector(verts)
    y = {r.id: r.y for r in sr.multiply(m, v0).collect()}
    assert y == pytest.approx({"a": 0.0, "b": 1 / 6, "c": 1 / 6 + 1 / 3})
    d = sr.damp(sr.multiply(m, v0), 0.2)
    total = sr.vector_sum(d).collect()[0]["vector_sum"]
    assert total == pytest.approx(0.8 * 2 / 3)
    v1 = {r.id: r.rank for r in sr.redistribute(d, 3, total).collect()}
    assert sum(v1.values()) == pytest.approx(1.0)
    step = {r.id: r.rank for r in sr.rank_step(m, v0, 0.2, 3).collect()}
    assert step == pytest.approx(v1)
    diff = {r.id: r.abs_diff for r in sr.abs_difference(sr.redistribute(d, 3, total), v0).collect()}
    assert diff == pytest.approx({k: abs(v1[k] - 1 / 3) for k in v1})
    l1 = sr.l1_distance(sr.redistribute(d, 3, total), v0).collect()[0]["l1"]
    assert l1 == pytest.approx(sum(diff.values()))


@pytest.mark.parametrize("n,d", [(11, 4), (12, 4), (3, 4), (100, 7), (1, 1)])
def test_blocks_match_ntile(spark, n, d):
    idx = spark.range(n).select(F.col("id").alias("idx"))
    got = sr.assign_block(idx, n, d)
    tiles = idx.select("idx", (F.ntile(d).over(Window.orderBy("idx")) - 1).alias("t"))
    joined = got.join(tiles, "idx").collect()
    assert len(joined) == n
    assert all(r.block == r.t for r in joined)
    starts = {}
    for r in joined:
        starts.setdefault(r.block, r.idx - r.entry)
    assert all(r.idx - r.entry == starts[r.block] for r in joined)


def test_block_matrix_roundtrip(spark, edges_of):
    edges = edges_of("1>2 2>3 3>1 3>4 4>5 5>1 1>1", id_type="long")
    index = sr.vertex_index(edges)
    n = index.count()
    indexed = sr.index_matrix(sr.transition_matrix(edges, collapse=False), index)
    back = sr.unblock(sr.block_matrix(indexed, n, 3), n, 3)
    assert sorted(back.collect()) == sorted(indexed.select("src_idx", "dst_idx", "w").collect())


def test_split_join_equals_join(spark):
    big = spark.range(2000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), "id")
    dim = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = spark.createDataFrame([(0,)], "k long")
    plain = sorted(big.join(dim, "k").collect())
    split = sorted(split_join(big, dim, "k", hot).select("k", "id", "v").collect())
    assert split == plain
    left = sorted(split_join(big, dim.filter("k > 5"), "k", hot, how="left").select("k", "id", "v").collect())
    assert left == sorted(big.join(dim.filter("k > 5"), "k", "left").collect())


def test_with_next_matches_window_lead(spark):
    # user 1 owns a third of all rows and spans several range partitions
    rows = [(1 if i % 3 == 0 else i % 17, i * 10 % 997, i) for i in range(900)]
    df = spark.createDataFrame(rows, "u long, ts long, eid long").withColumn("val", F.concat(F.lit("e"), F.col("eid")))
    got = with_next(df, "u", ["ts", "eid"], "val", "nxt", num_partitions=7)
    want = df.select(
        "u", "ts", "eid", "val", F.lead("val").over(Window.partitionBy("u").orderBy("ts", "eid")).alias("nxt")
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_local_rows_exact_and_jvm_only(spark):
    from pyspark.sql import types as T

    from surfrank.functions.values import local_rows

    schema = T.StructType(
        [T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()), T.StructField("n", T.LongType())]
    )
    rows = [("it's \\ \"q\" é", 0.1 + 0.2, 2**62), ("", 1e-300, -1), (None, None, None)]
    df = local_rows(spark, rows, schema)
    assert df.collect() == [tuple(r) for r in rows] or [tuple(r) for r in df.collect()] == rows
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert local_rows(spark, [], schema).count() == 0


def test_read_table_edges_prunes_columns(spark):
    edges = sr.read_table_edges(spark, "/root/testdata/sf0.001/lineitem.parquet", "l_partkey", "l_suppkey")
    assert edges.columns == ["src", "dst"]
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in edges._jdf.queryExecution().executedPlan().toString()
    assert edges.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_with_next_more_tasks_than_rows(spark):
    # most range tasks are empty: successors must still be found across them
    rows = [(i % 3, i, i) for i in range(20)]
    df = spark.createDataFrame(rows, "u long, ts long, eid long").withColumn("val", F.col("eid").cast("string"))
    got = with_next(df, "u", ["ts", "eid"], "val", "nxt", num_partitions=50)
    want = df.select(
        "u", "ts", "eid", "val", F.lead("val").over(Window.partitionBy("u").orderBy("ts", "eid")).alias("nxt")
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_reader_keeps_empty_fields(spark, tmp_dir):
    path = os.path.join(tmp_dir, "g.tsv")
    with open(path, "w") as f:
        f.write("\tb\na\tb\nb\ta\na\t\n#x\ty\n\nq\n")
    edges = sr.read_edges(spark, path, on_malformed="drop")
    assert sorted(map(tuple, edges.collect())) == [("", "b"), ("a", ""), ("a", "b"), ("b", "a")]
    with pytest.raises(Exception, match="malformed edge line"):
        sr.read_edges(spark, path).collect()
    ranks = sr.rank(edges, epsilon=0.0, max_iter=20).ranks.collect()
    assert sum(r["rank"] for r in ranks) == pytest.approx(1.0, abs=1e-12) and len(ranks) == 3


def test_null_ends_raise_or_go(spark, tmp_dir):
    edges = spark.createDataFrame([("a", "b"), ("b", None), ("b", "a"), (None, "a")], "src string, dst string")
    with pytest.raises(Exception, match="null end"):
        sr.rank(edges)
    path = os.path.join(tmp_dir, "t")
    edges.write.parquet(path)
    kept = sr.read_table_edges(spark, path, on_null="drop")
    assert sorted(map(tuple, kept.collect())) == [("a", "b"), ("b", "a")]
    with pytest.raises(Exception, match="null end"):
        sr.read_table_edges(spark, path).collect()


def test_with_next_does_not_rest_on_reused_exchanges(spark):
    from pyspark.sql import Window

    from surfrank.functions.sequence import with_next
    from surfrank.session import scoped_conf

    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet").select("user_id", "ts", "event_id", "event_type")
    order = ["ts", "event_id"]
    with scoped_conf(spark, {"spark.sql.exchange.reuse": "false"}):
        got = with_next(events, "user_id", order, "event_type", num_partitions=64)
        want = events.withColumn("next_value", F.lead("event_type").over(Window.partitionBy("user_id").orderBy(*order)))
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == events.count()
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_range") == 2  # event rows once, one row per range once
    assert "rangepartitioning" not in plan
