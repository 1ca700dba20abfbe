"""Saved layouts, prepared handles, run progress, exact sums, sessions and lazy hot keys."""

from __future__ import annotations

import json
import math
import os
import random
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import surfrank as sr
from surfrank.functions.exact import UNIT, exact_sum, unit_weights
from surfrank.functions.skew import hot_pieces, salted_join
from surfrank.plans import rank as loop
from surfrank.plans.layout import LinkMatrix, _partitions
from surfrank.plans.rank import next_vector, start_vector
from tests.test_plans import _nodes


def _edges(spark, n=400, pages=60, seed=3, parts=3):
    rng = random.Random(seed)
    rows = [(f"p{rng.randrange(pages)}", f"p{rng.randrange(pages)}") for _ in range(n)]
    rows += [("hub", f"p{i}") for i in range(pages)] + [("hub", "sink")] * 5
    return spark.createDataFrame(rows, "src string, dst string").repartition(parts)


def _dict(df):
    return {r["id"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("encode_ids", [False, True])
@pytest.mark.parametrize("hot_min_rows", [10_000, 1])
def test_saved_layout_ranks_alike_and_loads_without_a_shuffle(spark, tmp_dir, hot_min_rows, encode_ids):
    edges, path = _edges(spark), os.path.join(tmp_dir, "it's a matrix")
    want = _dict(sr.rank(edges, preset="notebook").ranks)
    built = LinkMatrix.build(edges, 3, hot_min_rows=hot_min_rows, max_hot=8, encode_ids=encode_ids)
    for _ in range(2):  # a layout that stands there is replaced
        built.save(path)
    built.unpersist()
    lm = LinkMatrix.load(spark, path)
    try:
        assert (lm.hot is not None) == (hot_min_rows == 1) and lm.edge_rows == 465 and lm.num_partitions == 3
        for df in (lm.cold, lm.vertices):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        nodes = _nodes(next_vector(lm, start_vector(lm, None), 0.2, 0.0))
        assert nodes.count("Exchange") == 1, nodes  # already of the first step
        got = sr.rank(matrix=lm, preset="notebook")
        assert _dict(got.ranks) == pytest.approx(want, abs=1e-12) and got.converged
        again = sr.rank(matrix=lm, epsilon=0.0, max_iter=2)  # the handle stays usable
        assert again.iterations == 2 and again.ranks.sparkSession is spark
    finally:
        lm.unpersist()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("surfrank_")]
    assert os.path.exists(f"{path}/matrix.json")


def test_unfinished_or_missing_layout_is_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    with pytest.raises(ValueError, match="no whole matrix"):
        LinkMatrix.load(spark, path)
    lm = LinkMatrix.build(_edges(spark))
    lm.save(path)
    lm.unpersist()
    os.remove(f"{path}/matrix.json")
    with pytest.raises(ValueError, match="no whole matrix"):
        LinkMatrix.load(spark, path)


def test_ranking_from_weights(spark, edges_of, tmp_dir):
    edges = edges_of("a>b a>b a>c b>b b>c c>a c>d")
    want = _dict(sr.rank(edges, preset="notebook").ranks)
    matrix = sr.transition_matrix(edges, collapse=False)  # equal coordinates are added up
    matrix.write.parquet(os.path.join(tmp_dir, "w"))
    got = sr.rank(matrix=sr.read_matrix(spark, os.path.join(tmp_dir, "w")), preset="notebook")
    assert _dict(got.ranks) == pytest.approx(want, abs=1e-12)
    with pytest.raises(ValueError, match="differ from a sum of 1"):
        sr.rank(matrix=matrix.withColumn("w", F.col("w") * 2))
    for bad in (-1.0, None, float("nan")):
        with pytest.raises(Exception, match="negative or missing"):
            sr.rank(matrix=matrix.withColumn("w", F.lit(bad).cast("double")))
    with pytest.raises(ValueError, match="either"):
        sr.rank(edges, matrix=matrix)
    with pytest.raises(ValueError, match="either"):
        sr.rank()
    empty = sr.rank(matrix=matrix.filter(F.lit(False)))
    assert empty.converged and empty.ranks.collect() == []


def test_ten_steps_over_a_handle_read_the_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    edges = _edges(spark).cache()
    n = edges.count()
    lm = LinkMatrix.build(edges.mapInPandas(counted, "src string, dst string"))
    vec = sr.initial_vector(sr.vertices(edges), lm.n)
    for _ in range(10):
        vec = sr.rank_step(lm, vec, 0.2)
    got = _dict(vec)
    assert read.value == n
    product = {r["id"]: r["y"] for r in sr.multiply(lm, vec).collect()}
    lm.unpersist()
    edges.unpersist()
    assert got == pytest.approx(_dict(sr.rank(edges, epsilon=0.0, max_iter=10).ranks), abs=1e-12)
    plain = {r["id"]: r["y"] for r in sr.multiply(sr.transition_matrix(edges), spark.createDataFrame(list(got.items()), "id string, rank double")).collect()}
    assert product == pytest.approx(plain, abs=1e-12)
    with pytest.raises(ValueError, match="number of vertices"):
        sr.rank_step(sr.transition_matrix(edges), vec, 0.2)


def test_reproducible_runs_have_the_same_bits(spark):
    runs = []
    for parts, seed in ((1, 1), (3, 2), (64, 3)):
        shuffled = _edges(spark, 2000, 150).orderBy(F.rand(seed)).repartition(parts)
        r = sr.rank(shuffled, preset="notebook", reproducible=True, num_partitions=parts, hot_min_rows=1 if parts == 3 else 10_000, max_hot=8)
        runs.append((r.iterations, [(s.vector_sum, s.l1_delta) for s in r.steps], _dict(r.ranks)))
    assert runs[0] == runs[1] == runs[2]
    plain = sr.rank(_edges(spark, 2000, 150), preset="notebook")
    assert _dict(plain.ranks) == pytest.approx(runs[0][2], abs=1e-12) and plain.iterations == runs[0][0]


def test_exact_sums(spark):
    rng = random.Random(8)
    values = [rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 6) for _ in range(3000)]
    got = set()
    for parts in (1, 3, 64):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        got.add(df.agg(exact_sum(F.col("x")).alias("s")).first()["s"])
        vec = df.select(F.col("x").alias("y"), F.lit(1).alias("id"))
        got.add(sr.vector_sum(vec).first()["vector_sum"])
    assert len(got) == 1 and got.pop() == pytest.approx(math.fsum(values), abs=1e-9)
    none = spark.createDataFrame([(None,)], "x double")
    assert none.agg(exact_sum(F.col("x")).alias("s")).first()["s"] is None
    assert unit_weights(0.5) == UNIT and unit_weights(3.0) == (59, 81)
    big = spark.createDataFrame([("a", 50.0), ("b", -3.0)], "id string, rank double")
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    with_big = sr.rank(edges, epsilon=0.0, max_iter=3, initial=big, reproducible=True)
    assert sum(_dict(with_big.ranks).values()) == pytest.approx(1)


@pytest.mark.parametrize("encode_ids", [False, True])
def test_killed_run_goes_on_where_it_stood(spark, tmp_dir, monkeypatch, encode_ids):
    edges, path = _edges(spark), os.path.join(tmp_dir, "run")
    whole = sr.rank(edges, preset="script", reproducible=True, encode_ids=encode_ids)
    written = loop._Progress.step
    calls = []

    def dies(self, *args):
        written(self, *args)
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt

    monkeypatch.setattr(loop._Progress, "step", dies)
    with pytest.raises(KeyboardInterrupt):
        sr.rank(edges, preset="script", reproducible=True, progress=path, encode_ids=encode_ids)
    monkeypatch.setattr(loop._Progress, "step", written)
    manifests = [n for n in os.listdir(path) if n.startswith("manifest-")]
    assert manifests == ["manifest-0000000003.json"] and len(json.load(open(f"{path}/{manifests[0]}"))["steps"]) == 3
    os.makedirs(f"{path}/step-0000000004")  # a vector without a manifest was not whole
    rest = sr.rank(edges, preset="script", reproducible=True, progress=path, resume=True, encode_ids=encode_ids)
    assert [(s.iteration, s.vector_sum, s.l1_delta) for s in rest.steps] == [(s.iteration, s.vector_sum, s.l1_delta) for s in whole.steps]
    assert _dict(rest.ranks) == _dict(whole.ranks) and rest.converged
    done = sr.rank(edges, preset="script", progress=path, resume=True, encode_ids=encode_ids)  # nothing is left to do
    assert done.iterations == whole.iterations and done.converged and _dict(done.ranks) == _dict(whole.ranks)
    with pytest.raises(ValueError, match="teleport"):
        sr.rank(edges, preset="cluster", compare_first=False, progress=path, resume=True, encode_ids=encode_ids)
    with pytest.raises(ValueError, match="progress folder"):
        sr.rank(edges, resume=True)


def test_callers_session_keeps_its_settings_while_a_run_is_on(spark, monkeypatch):
    seen, inside = [], threading.Event()
    plain = loop.next_vector

    def watched(*args):
        inside.set()
        seen.append((spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")))
        return plain(*args)

    before = (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(loop, "next_vector", watched)
    run = threading.Thread(target=lambda: sr.rank(_edges(spark), epsilon=0.0, max_iter=4, num_partitions=7))
    run.start()
    assert inside.wait(120)
    plan = spark.range(100).groupBy(F.col("id") % 3).count()._jdf.queryExecution().executedPlan().toString()
    run.join()
    assert plan.startswith("AdaptiveSparkPlan") and set(seen) == {before} and len(seen) == 4
    res = sr.rank(_edges(spark), epsilon=0.0, max_iter=1, num_partitions=7)
    assert res.ranks.sparkSession is spark and res.history.sparkSession is spark


def test_hot_keys_are_found_without_a_job(spark):
    edges = _edges(spark).cache()
    edges.count()
    index = spark.createDataFrame([(f"p{i}", i) for i in range(60)] + [("hub", 60), ("sink", 61)], "id string, idx long")
    spark.sparkContext.setJobGroup("lazy", "frames that start no job")
    frames = {
        "degree": sr.with_out_degree(edges, max_hot=4),
        "plain": sr.transition_matrix(edges, collapse=False, max_hot=4),
        "merged": sr.transition_matrix(edges, max_hot=4),
        "indexed": sr.index_edges(edges, index, max_hot=4),
        "blocks": sr.index_matrix(sr.transition_matrix(edges), index),
        "product": sr.multiply(sr.transition_matrix(edges), index.select("id", F.lit(1.0).alias("rank"))),
    }
    tracker = spark.sparkContext.statusTracker()
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    for df in frames.values():
        text = df._jdf.queryExecution().analyzed().toString()
        assert "LocalRelation" not in text  # no list of keys in a plan
    rows = sorted((r.src, r.dst) for r in edges.collect())
    assert sorted((r.src, r.dst) for r in frames["degree"].collect()) == rows
    ids = {r.id: r.idx for r in index.collect()}
    assert sorted((r.src_idx, r.dst_idx) for r in frames["indexed"].collect()) == sorted((ids[a], ids[b]) for a, b in rows)
    spark.sparkContext._jsc.clearJobGroup()
    edges.unpersist()


def test_salted_join_deals_a_hot_key_over_its_pieces(spark):
    big = spark.range(0, 3000, 1, 6).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), F.lit("x").alias("v"))
    dim = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    counts = big.groupBy("k").count()
    hot = hot_pieces(counts, "k", "count", max_hot=10)
    assert [tuple(r) for r in hot.collect()] == [(0, 4)]  # 1000 of 3000 rows, 300 make a piece
    got = salted_join(big, dim, "k", hot)
    assert got.columns == ["k", "v", "d"]
    assert sorted(map(tuple, got.collect())) == sorted((r.k, r.v, r.k * 2) for r in big.collect())
    left = salted_join(big, dim.filter("k > 5"), "k", hot, how="left")
    assert sorted(map(str, left.collect())) == sorted(map(str, big.join(dim.filter("k > 5"), "k", "left").collect()))
    assert hot_pieces(counts.filter(F.lit(False)), "k", "count").collect() == []


def test_partitions_follow_data_and_cores():
    assert _partitions(10, 2_097_152, 8000) == 1
    assert _partitions(590_000, 2_097_152, 8) == 8  # all cores
    assert _partitions(100_000, 2_097_152, 8000) == 4  # no crumbs
    assert _partitions(10**12, 2_097_152, 8000) == 476_838


def test_read_report_counts_in_the_scan(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "e.tsv"), "w") as f:
        f.write("# c\na\tb\n\nlost\n#x\ty\n\tb\na\tb\tmore\n")
    report = Observation()
    edges = sr.read_edges(spark, os.path.join(tmp_dir, "e.tsv"), on_malformed="drop", report=report)
    assert sr.rank(edges, preset="script").n == 3
    assert report.get == {"lines": 7, "comments": 2, "blanks": 1, "malformed": 1, "edges": 3}
    ends = Observation()
    nulls = spark.createDataFrame([("a", None), ("a", "b")], "src string, dst string")
    assert sr.complete_edges(nulls, "drop", ends).count() == 1 and ends.get == {"rows": 2, "null_ends": 1}


def test_single_file_is_joined_or_refused(spark, tmp_dir):
    ranks = spark.range(500).select(F.col("id"), (F.col("id") / 3).alias("rank")).repartition(5)
    path = os.path.join(tmp_dir, "one")
    sr.write_ranks(ranks, path, ordered=True, single_file=True)
    files = [n for n in os.listdir(path) if not n.startswith((".", "_"))]
    assert files == ["part-00000"]
    with open(f"{path}/part-00000") as f:
        assert [int(line.split("\t")[0]) for line in f] == list(range(500))
    sr.write_ranks(ranks.filter("id < 0"), path, single_file=True)  # replaces, also by nothing
    assert os.path.getsize(f"{path}/part-00000") == 0
    with pytest.raises(ValueError, match="single file"):
        sr.write_ranks(ranks, path, fmt="parquet", single_file=True)


def test_callers_shuffle_number_does_not_shuffle_the_matrix(spark):
    """The start vector lies as the matrix does, whatever the caller's number of shuffle partitions."""
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    for encode_ids in (False, True):
        lm = LinkMatrix.build(_edges(spark), 3, encode_ids=encode_ids)
        try:
            vec = start_vector(lm, None)
            for _ in range(2):
                plan = next_vector(lm, vec, 0.2, 0.0)
                nodes = _nodes(plan)
                assert nodes.count("Exchange") == 1, nodes  # the sums per target alone
                vec = plan.select("id", "rank", "sink").checkpoint()
                assert vec.rdd.getNumPartitions() == lm.num_partitions
        finally:
            lm.unpersist()


def test_shuffle_files_go_with_their_step(spark, monkeypatch):
    """What a run's shuffles leave on disk does not grow with the number of steps."""
    import glob

    jvm = spark.sparkContext._jvm
    folders = [f.getPath() for f in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return sum(len(glob.glob(f"{d}/*/shuffle_*")) for d in folders)

    original, seen = loop.next_vector, []

    def counted(*args, **kwargs):
        seen.append(files())
        return original(*args, **kwargs)

    monkeypatch.setattr(loop, "next_vector", counted)
    sr.rank(_edges(spark), epsilon=0.0, max_iter=8, num_partitions=3)
    assert max(seen[4:]) <= seen[2]


@pytest.mark.parametrize("collide", [False, True])
def test_long_runs_encode_text_ids_without_a_join(spark, monkeypatch, collide):
    """Where entries are many the loop runs on 64-bit hashes; where two ids share one it numbers them."""
    from surfrank.plans import layout

    want = _dict(sr.rank(_edges(spark), preset="notebook").ranks)
    monkeypatch.setattr(layout, "ENCODED_FROM", 1)
    numbered = []
    monkeypatch.setattr(layout, "_encode", lambda *a, f=layout._encode: numbered.append(1) or f(*a))
    if collide:
        monkeypatch.setattr(layout, "_hashed", lambda *a: None)
    lm = LinkMatrix.build(_edges(spark), encode_ids=None)
    assert lm.dictionary is not None and lm.cold.schema["src"].dataType.simpleString() == "bigint"
    assert len(numbered) == collide
    lm.unpersist()
    assert _dict(sr.rank(_edges(spark), preset="notebook").ranks) == pytest.approx(want, abs=1e-12)


def test_equal_hashes_are_seen(spark, monkeypatch):
    from surfrank.plans import layout

    monkeypatch.setattr(layout.F, "xxhash64", lambda c: F.length(c).cast("long"))
    pairs = spark.createDataFrame([("a", "b", 1)], "src string, dst string, copies long")
    verts = spark.createDataFrame([("a", 1, 1, 0), ("b", 0, 0, 1)], "id string, out_degree long, entries long, in_entries long")
    assert layout._hashed(pairs, verts, 2) is None


def test_given_partitions_are_multiplied_for_many_entries(spark):
    """Three partitions of a large matrix would be three tasks with no bound on their rows."""
    lm = LinkMatrix.build(_edges(spark), 3, rows_per_partition=40)
    try:
        assert lm.num_partitions % 3 == 0 and lm.entries / lm.num_partitions <= 40
        assert lm.cold.rdd.getNumPartitions() == lm.num_partitions
    finally:
        lm.unpersist()
    small = LinkMatrix.build(_edges(spark), 3)
    assert small.num_partitions == 3
    small.unpersist()
