"""The convergence loop on the tiny graphs of FIXTURES.md, plus invariants."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import surfrank as sr

# golden values (9 decimals) and step counts per preset, from FIXTURES.md
GOLDEN = {
    "G1": (
        "a>b b>c c>a",
        {
            "script": ({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, 2),
            "cluster": ({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, 1),
            "notebook": ({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, 2),
        },
    ),
    "G2": (
        "a>b a>c b>c",
        {
            "script": ({"a": 0.20324996, "b": 0.284548695, "c": 0.512201345}, 9),
            "cluster": ({"a": 0.197580035, "b": 0.28155081, "c": 0.520869154}, 12),
            "notebook": ({"a": 0.203252033, "b": 0.284552846, "c": 0.512195122}, 21),
        },
    ),
    "G3": (
        "a>b a>b a>c b>b b>c c>a c>d",
        {
            "script": ({"a": 0.199469037, "b": 0.327127388, "c": 0.273934538, "d": 0.199469037}, 7),
            "cluster": ({"a": 0.196430702, "b": 0.331397306, "c": 0.275741289, "d": 0.196430702}, 8),
            "notebook": ({"a": 0.199468085, "b": 0.32712766, "c": 0.27393617, "d": 0.199468085}, 16),
        },
    ),
    "G4": (
        "a>b b>a x>y z>y",
        {
            "script": (
                {"a": 0.342442948, "b": 0.342442948, "x": 0.068501098, "z": 0.068501098, "y": 0.178111907},
                17,
            ),
            "cluster": (
                {"a": 0.369682851, "b": 0.369682851, "x": 0.055453889, "z": 0.055453889, "y": 0.149726521},
                24,
            ),
            "notebook": (
                {"a": 0.342465753, "b": 0.342465753, "x": 0.068493151, "z": 0.068493151, "y": 0.178082192},
                43,
            ),
        },
    ),
    "G5": (
        "a>a",
        {
            "script": ({"a": 1.0}, 2),
            "cluster": ({"a": 1.0}, 1),
            "notebook": ({"a": 1.0}, 2),
        },
    ),
}


def _as_dict(df):
    return {r["id"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("graph", sorted(GOLDEN))
@pytest.mark.parametrize("preset", ["script", "cluster", "notebook"])
def test_golden(spark, edges_of, graph, preset):
    spec, expected = GOLDEN[graph]
    want, steps = expected[preset]
    res = sr.rank(edges_of(spec), preset=preset)
    got = _as_dict(res.ranks)
    assert res.iterations == steps
    assert res.converged
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=2e-9)


def test_never_settles_reaches_cap(spark, edges_of):
    res = sr.rank(edges_of("a>b b>a c>a"), teleport=0.0, epsilon=1e-4, max_iter=300)
    assert res.iterations == 300
    assert not res.converged
    got = _as_dict(res.ranks)
    assert got["a"] == pytest.approx(1 / 3, abs=1e-9)
    assert got["b"] == pytest.approx(2 / 3, abs=1e-9)
    assert got["c"] == pytest.approx(0.0, abs=1e-12)


def test_empty_graph(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    res = sr.rank(empty)
    assert res.iterations == 0 and res.converged
    assert res.ranks.count() == 0
    assert res.ranks.columns == ["id", "rank"]


def _numpy_rank(pairs, t, steps):
    ids = sorted({a for a, _ in pairs} | {b for _, b in pairs})
    ix = {v: i for i, v in enumerate(ids)}
    n = len(ids)
    m = np.zeros((n, n))
    outdeg = {}
    for a, _ in pairs:
        outdeg[a] = outdeg.get(a, 0) + 1
    for a, b in pairs:
        m[ix[b], ix[a]] += 1.0 / outdeg[a]
    v = np.ones(n) / n
    for _ in range(steps):
        v = (1 - t) * m.dot(v)
        v = v + (1 - v.sum()) / n
    return dict(zip(ids, v))


@pytest.fixture(scope="module")
def random_graph():
    rng = np.random.default_rng(7)
    n = 60
    pairs = [(f"v{a}", f"v{b}") for a, b in rng.integers(0, n, size=(400, 2))]
    pairs += [("v0", f"v{b}") for b in rng.integers(0, n, size=150)]  # a hub source
    pairs += [(f"v{a}", "v1") for a in rng.integers(0, n, size=150)]  # a hub target
    pairs += [("v5", "w_sink"), ("w_src", "v3")]
    return pairs


@pytest.mark.parametrize("strategy", ["partitioned", "broadcast"])
@pytest.mark.parametrize("hot_min_rows", [10_000, 1])
@pytest.mark.parametrize("encode_ids", [False, True])
def test_strategies_match_numpy(spark, random_graph, strategy, hot_min_rows, encode_ids):
    edges = spark.createDataFrame(random_graph, "src string, dst string")
    res = sr.rank(
        edges,
        epsilon=0.0,
        max_iter=15,
        strategy=strategy,
        hot_min_rows=hot_min_rows,
        max_hot=4,
        encode_ids=encode_ids,
    )
    want = _numpy_rank(random_graph, 0.2, 15)
    got = _as_dict(res.ranks)
    assert res.strategy == strategy
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12


def test_invariants(spark, random_graph):
    edges = spark.createDataFrame(random_graph, "src string, dst string")
    res = sr.rank(edges, teleport=0.15, epsilon=1e-12, max_iter=80)
    got = _as_dict(res.ranks)
    n = len(got)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-9)
    assert min(got.values()) >= 0.15 / n - 1e-12
    hist = sorted(res.history.collect(), key=lambda r: r["iteration"])
    deltas = [r["l1_delta"] for r in hist]
    assert deltas[0] is None
    for a, b in zip(deltas[1:], deltas[2:]):
        assert b <= (1 - 0.15) * a + 1e-12


def test_edge_order_renaming_and_duplication(spark, random_graph):
    base = _as_dict(sr.rank(spark.createDataFrame(random_graph, "src string, dst string"), epsilon=0.0, max_iter=10).ranks)
    shuffled = list(reversed(random_graph))
    again = _as_dict(sr.rank(spark.createDataFrame(shuffled, "src string, dst string"), epsilon=0.0, max_iter=10).ranks)
    doubled = _as_dict(
        sr.rank(spark.createDataFrame(random_graph * 2, "src string, dst string"), epsilon=0.0, max_iter=10).ranks
    )
    renamed_pairs = [("x" + a, "x" + b) for a, b in random_graph]
    renamed = _as_dict(sr.rank(spark.createDataFrame(renamed_pairs, "src string, dst string"), epsilon=0.0, max_iter=10).ranks)
    for k, v in base.items():
        assert again[k] == pytest.approx(v, abs=1e-15)
        assert doubled[k] == pytest.approx(v, abs=1e-15)
        assert renamed["x" + k] == pytest.approx(v, abs=1e-15)


def test_history_and_initial_vector(spark, edges_of):
    edges = edges_of("a>b a>c b>c")
    res = sr.rank(edges, preset="script")
    hist = sorted(res.history.collect(), key=lambda r: r["iteration"])
    assert [r["iteration"] for r in hist] == list(range(1, res.iterations + 1))
    # step 1: v0 = 1/3 each, c is a sink: sum(y) = 0.8 * 2/3
    assert hist[0]["vector_sum"] == pytest.approx(0.8 * 2 / 3, abs=1e-15)
    assert hist[0]["l1_delta"] is None and hist[-1]["l1_delta"] < 1e-4
    # restarting from the result converges at once (cluster rule compares step 1)
    again = sr.rank(edges, preset="cluster", teleport=0.2, epsilon=1e-4, initial=res.ranks)
    assert again.iterations <= 2


def test_parameters_override_preset(spark, edges_of):
    res = sr.rank(edges_of("a>b a>c b>c"), preset="notebook", max_iter=3)
    assert res.iterations == 3 and not res.converged


def test_long_ids(spark, edges_of):
    res = sr.rank(edges_of("1>2 1>3 2>3", id_type="long"), preset="script")
    got = _as_dict(res.ranks)
    assert got[1] == pytest.approx(0.20324996, abs=2e-9)
    assert res.ranks.schema["id"].dataType.simpleString() == "bigint"


def test_encoded_ids_with_restart(spark, edges_of):
    edges = edges_of("a>b a>c b>c")
    res = sr.rank(edges, preset="script", encode_ids=True)
    got = _as_dict(res.ranks)
    assert got["a"] == pytest.approx(0.20324996, abs=2e-9)
    assert res.ranks.schema["id"].dataType.simpleString() == "string"
    again = sr.rank(edges, preset="cluster", teleport=0.2, epsilon=1e-4, initial=res.ranks, encode_ids=True)
    assert again.iterations <= 2


def test_result_survives_cache_loss(spark, edges_of):
    res = sr.rank(edges_of("a>b a>c b>c"), preset="script")
    spark.catalog.clearCache()
    assert res.ranks.agg(F.sum("rank")).collect()[0][0] == pytest.approx(1.0, abs=1e-12)


def test_survives_losing_cached_blocks(spark, random_graph, monkeypatch):
    """Dropping every cached block mid-loop (what a lost executor does to its share)
    must not change the result: the matrix comes back from its checkpoint files and
    the vector from the previous step's checkpoint."""
    import surfrank.plans.rank as rank_module

    edges = spark.createDataFrame(random_graph, "src string, dst string")
    want = _as_dict(sr.rank(edges, epsilon=0.0, max_iter=8, hot_min_rows=1, max_hot=4).ranks)
    original = rank_module.next_vector
    calls = {"n": 0}

    def losing(*args, **kwargs):
        calls["n"] += 1
        if calls["n"] == 4:
            spark.catalog.clearCache()
        return original(*args, **kwargs)

    monkeypatch.setattr(rank_module, "next_vector", losing)
    got = _as_dict(sr.rank(edges, epsilon=0.0, max_iter=8, hot_min_rows=1, max_hot=4).ranks)
    assert calls["n"] == 8
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-15


def test_no_cap_and_cap(spark, edges_of):
    edges = edges_of("a>b b>a c>a")
    slow = sr.rank(edges, preset="cluster", teleport=0.01)
    assert slow.converged and slow.iterations > 300
    capped = sr.rank(edges, preset="cluster", teleport=0.01, max_iter=300)
    assert not capped.converged and capped.iterations == 300


def test_long_ids_change_nothing(spark):
    pairs = [("a", "b"), ("b", "c"), ("b", "a"), ("c", "d")]
    far = "http://example.org/" + "long/" * 20
    short = _as_dict(sr.rank(spark.createDataFrame(pairs, "src string, dst string")).ranks)
    long_edges = spark.createDataFrame([(far + a, far + b) for a, b in pairs], "src string, dst string")
    for encode in (False, True):
        got = _as_dict(sr.rank(long_edges, encode_ids=encode).ranks)
        assert {k[len(far) :]: v for k, v in got.items()} == pytest.approx(short, abs=1e-12)


def test_broadcast_beyond_budget_fails(spark, edges_of):
    from surfrank.session import scoped_conf

    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "10"}), pytest.raises(ValueError, match="partitioned"):
        sr.rank(edges_of("a>b b>a"), strategy="broadcast")


def test_duplicate_start_vector_fails(spark, edges_of):
    start = spark.createDataFrame([("a", 0.5), ("a", 0.5)], "id string, rank double")
    with pytest.raises(ValueError, match="twice"):
        sr.rank(edges_of("a>b b>a"), initial=start)


def test_release_leaves_no_checkpoint(spark, edges_of):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    count = lambda: len(fs.listStatus(folder))
    edges = edges_of("a>b a>c b>c c>a")
    before = count()
    sr.release_checkpoints()
    before = count()
    sr.rank(edges, hot_min_rows=1).release()
    sr.vertex_index(edges).count()
    sr.rank_step(sr.transition_matrix(edges), sr.initial_vector(sr.vertices(edges)), 0.2, 3).count()
    sr.release_checkpoints()
    assert count() == before


@pytest.mark.parametrize("hot_min_rows", [10_000, 1])
def test_broadcast_of_a_vector_above_the_threshold_goes_in_slices(spark, random_graph, tmp_dir, hot_min_rows):
    from surfrank.plans.layout import MAX_SLICES, LinkMatrix, _slices
    from surfrank.session import scoped_conf

    edges = spark.createDataFrame(random_graph, "src string, dst string")
    want = _as_dict(sr.rank(edges, preset="notebook").ranks)
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "500"}):  # 62 rows of about 35 bytes
        got = sr.rank(edges, preset="notebook", strategy="broadcast", hot_min_rows=hot_min_rows, max_hot=4)
        assert _as_dict(got.ranks) == pytest.approx(want, abs=1e-12) and got.strategy == "broadcast"
        lm = LinkMatrix.build(edges, 3, "broadcast", hot_min_rows=hot_min_rows, max_hot=4)
        assert lm.slices == 5 and lm.matrix().columns == ["src", "dst", "w"]
        sql = lm.contribution_sql("v")
        assert sql.count("BROADCAST(p)") == (5 if lm.hot is None else 10)
        lm.save(f"{tmp_dir}/sliced")
        lm.unpersist()
    loaded = LinkMatrix.load(spark, f"{tmp_dir}/sliced")
    assert loaded.slices == 5 and _as_dict(sr.rank(matrix=loaded, preset="notebook").ranks) == pytest.approx(want, abs=1e-12)
    loaded.unpersist()
    assert _slices(100, 40.0, 4000) == 1 and _slices(1_200_000, 40.0, 10 << 20) == 6
    with pytest.raises(ValueError, match="partitioned"):
        _slices(10**9, 40.0, MAX_SLICES * 100_000)
