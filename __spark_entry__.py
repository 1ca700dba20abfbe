"""

``entry(spark)`` runs the flagship query (ranking of the part -> supplier
graph, preset "script") on sf0.001.  ``queries()`` holds one callable per
DuckDB SQL over the pre-registered tables.  All doubles are rounded to 10
decimals on both sides and every column is aliased to the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import surfrank as sr
from surfrank.functions.values import local_rows
from surfrank.session import checkpoint_dir
from surfrank.sources import tables

try:
    import corpus_pipeline
    from surfrank.llm import queries as corpus
except ModuleNotFoundError as e:  # the corpus operators are an optional part, and so is what they import
    if (e.name or "").split(".")[0] == "surfrank" and not e.name.startswith("surfrank.llm"):
        raise
    corpus = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 10
TELEPORT = 0.2  # preset "script"
SLOW_TELEPORT = 0.035
BLOCKS = 4
NO_CAP = 100_000  # steps in SQL where the preset has no cap


def _r(col: str, name: str | None = None):
    return F.round(F.col(col), DIGITS).alias(name or col)


def _ranks(result: sr.RankResult) -> DataFrame:
    return result.ranks.select("id", _r("rank"))


# ---------------------------------------------------------------- graphs
GRAPHS = tables.GRAPHS
GRAPH_SQL = tables.GRAPH_SQL


# ---------------------------------------------------------------- spark side
def q_vertices(spark, sf):
    return sr.vertices(GRAPHS["page_links"](spark, sf))


def q_vertex_count(spark, sf):
    return sr.vertex_count(GRAPHS["cust_part"](spark, sf))


def q_vertex_index(spark, sf):
    return sr.vertex_index(GRAPHS["part_supp"](spark, sf))


def q_indexed_edges(spark, sf):
    e = GRAPHS["part_supp"](spark, sf)
    return sr.index_edges(e, sr.vertex_index(e))


def q_decoded_vector(spark, sf):
    """Converged ranks on dense ids, decoded back to original ids."""
    e = GRAPHS["part_supp"](spark, sf)
    index = sr.vertex_index(e)
    dense = sr.index_edges(e, index).select(F.col("src_idx").alias("src"), F.col("dst_idx").alias("dst"))
    res = sr.rank(dense, preset="script")
    vec = res.ranks.select(F.col("id").alias("idx"), "rank")
    return sr.decode_vector(vec, index).select("id", _r("rank"))


def q_out_degree(spark, sf):
    return sr.out_degree(GRAPHS["event_flow"](spark, sf))


def q_edges_with_out_degree(spark, sf):
    return sr.with_out_degree(GRAPHS["event_flow"](spark, sf))


def q_transition_matrix(spark, sf):
    return sr.transition_matrix(GRAPHS["part_supp"](spark, sf), collapse=False).select("src", "dst", _r("w"))


def q_transition_matrix_collapsed(spark, sf):
    return sr.transition_matrix(GRAPHS["event_flow"](spark, sf), collapse=True).select("src", "dst", _r("w"))


def q_initial_vector(spark, sf):
    return sr.initial_vector(sr.vertices(GRAPHS["page_links"](spark, sf))).select("id", _r("rank"))


def _first_step_parts(spark, sf, graph="part_supp"):
    e = GRAPHS[graph](spark, sf)
    verts = sr.vertices(e).persist()  # the count and the start vector read it
    n = verts.count()
    m = sr.transition_matrix(e)
    v0 = sr.initial_vector(verts, n)
    return m, v0, n


def q_multiply_once(spark, sf):
    m, v0, _ = _first_step_parts(spark, sf)
    return sr.multiply(m, v0).select("id", _r("y"))


def q_damped_vector(spark, sf):
    m, v0, _ = _first_step_parts(spark, sf)
    return sr.damp(sr.multiply(m, v0), TELEPORT).select("id", _r("y"))


def q_vector_sum(spark, sf):
    m, v0, _ = _first_step_parts(spark, sf)
    return sr.vector_sum(sr.damp(sr.multiply(m, v0), TELEPORT)).select(_r("vector_sum"))


def q_redistributed_vector(spark, sf):
    m, v0, n = _first_step_parts(spark, sf)
    y = sr.damp(sr.multiply(m, v0), TELEPORT).persist()  # the sum and the result read it
    total = y.agg(F.sum("y")).collect()[0][0]
    return sr.redistribute(y, n, total).select("id", _r("rank"))


def _two_steps(spark, sf):
    m, v0, n = _first_step_parts(spark, sf, "raw_part_supp")
    v1 = sr.rank_step(m, v0, TELEPORT, n)
    v2 = sr.rank_step(m, v1, TELEPORT, n)
    return v1, v2


def q_abs_difference(spark, sf):
    v1, v2 = _two_steps(spark, sf)
    return sr.abs_difference(v2, v1).select("id", _r("abs_diff"))


def q_l1_distance(spark, sf):
    v1, v2 = _two_steps(spark, sf)
    return sr.l1_distance(v2, v1).select(_r("l1"))


def q_rank_step(spark, sf):
    m, v0, n = _first_step_parts(spark, sf, "cust_part")
    return sr.rank_step(m, v0, TELEPORT, n).select("id", _r("rank"))


def _blocked(spark, sf):
    e = GRAPHS["raw_part_supp"](spark, sf)
    index = sr.vertex_index(e)
    n = index.count()
    return e, index, n


def q_block_assignment(spark, sf):
    _, index, n = _blocked(spark, sf)
    return sr.assign_block(index, n, BLOCKS)


def q_block_matrix(spark, sf):
    e, index, n = _blocked(spark, sf)
    indexed = sr.index_matrix(sr.transition_matrix(e, collapse=False), index)
    return sr.block_matrix(indexed, n, BLOCKS).select(
        "block_row", "block_col", "entry_row", "entry_col", _r("w")
    )


def q_unblocked_matrix(spark, sf):
    e, index, n = _blocked(spark, sf)
    indexed = sr.index_matrix(sr.transition_matrix(e, collapse=False), index)
    return sr.unblock(sr.block_matrix(indexed, n, BLOCKS), n, BLOCKS).select("src_idx", "dst_idx", _r("w"))


def q_rank_fixed20(spark, sf):
    return _ranks(sr.rank(GRAPHS["cust_part"](spark, sf), epsilon=0.0, max_iter=20))


def q_rank_script(spark, sf):
    return _ranks(sr.rank(GRAPHS["part_supp"](spark, sf), preset="script"))


def q_rank_cluster(spark, sf):
    return _ranks(sr.rank(GRAPHS["cust_part"](spark, sf), preset="cluster"))


def q_rank_notebook(spark, sf):
    return _ranks(sr.rank(GRAPHS["event_flow"](spark, sf), preset="notebook"))


def q_rank_partitioned(spark, sf):
    """A given number of partitions leaves the ranks as they are."""
    return _ranks(sr.rank(GRAPHS["cust_part"](spark, sf), preset="script", num_partitions=3))


def q_rank_broadcast(spark, sf):
    """Opt-in broadcast strategy (vector size checked against the session threshold)."""
    res = sr.rank(GRAPHS["raw_part_supp"](spark, sf), preset="cluster", strategy="broadcast")
    return _ranks(res)


def q_rank_hubs(spark, sf):
    res = sr.rank(GRAPHS["type_user"](spark, sf), preset="script", strategy="partitioned", hot_min_rows=1)
    return _ranks(res)


def q_rank_encoded(spark, sf):
    """Loop on bigint ids (dictionary-encoded text ids), decoded at the end."""
    res = sr.rank(GRAPHS["cust_part"](spark, sf), preset="script", encode_ids=True, hot_min_rows=1)
    return _ranks(res)


def q_rank_history(spark, sf):
    res = sr.rank(GRAPHS["part_supp"](spark, sf), preset="script")
    return res.history.select("iteration", _r("vector_sum"), _r("l1_delta"))


def q_event_flow_edges(spark, sf):
    return GRAPHS["event_flow"](spark, sf)


def q_read_write_roundtrip(spark, sf):
    edges = GRAPHS["page_links"](spark, sf)
    note = spark.range(1).select(
        F.lit("# page links, written by surfrank").alias("src"), F.lit("-").alias("dst")
    )
    path = f"{checkpoint_dir(spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"
    sr.write_edges(note.unionByName(edges), path)
    return sr.read_edges(spark, path)


def q_ranks_file_roundtrip(spark, sf):
    """Rank file written as ``id<TAB>rank`` text (ordered) and read back."""
    res = sr.rank(GRAPHS["raw_part_supp"](spark, sf), preset="script")
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranks-{uuid.uuid4().hex}"
    sr.write_ranks(res.ranks, path, fmt="text", ordered=True)
    back = spark.read.schema("id bigint, rank double").option("sep", "\t").csv(path)
    return back.select("id", _r("rank"))


def q_rank_outcome(spark, sf):
    """Steps and outcome of a run without a cap that needs more than 300 steps."""
    res = sr.rank(GRAPHS["type_user"](spark, sf), preset="cluster", teleport=SLOW_TELEPORT)
    return res.history.agg(F.max("iteration").alias("iterations")).withColumn("converged", F.lit(res.converged))


def q_rank_flag_hubs(spark, sf):
    """Hub sources under the default settings."""
    return _ranks(sr.rank(GRAPHS["flag_order"](spark, sf), preset="script"))


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_edges_malformed_dropped(spark, sf):
    """Edge file with single-field lines, empty first fields and comments."""
    li = tables.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    line = (
        F.when(F.col("l_partkey") % 7 == 0, part)
        .when(F.col("l_partkey") % 7 == 1, F.concat(F.lit("\t"), supp))
        .when(F.col("l_partkey") % 7 == 2, F.concat(F.lit("#"), part, F.lit("\t"), supp))
        .when(F.col("l_partkey") % 7 == 3, F.concat(part, F.lit("\t"), supp, F.lit("\tmore")))
        .otherwise(F.concat(part, F.lit("\t"), supp))
    )
    path = _scratch(spark, "malformed")
    li.select(line.alias("value")).write.text(path)
    return sr.read_edges(spark, path, on_malformed="drop")


def q_edges_long_ids(spark, sf):
    path = _scratch(spark, "long-ids")
    sr.write_edges(GRAPHS["raw_part_supp"](spark, sf), path)
    return sr.read_edges(spark, path, id_type="long")


def q_rank_lookup(spark, sf):
    """Ranks of the suppliers' ids alone."""
    res = sr.rank(GRAPHS["raw_part_supp"](spark, sf), preset="script")
    ids = tables.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    return sr.lookup(res.ranks, ids).select("id", _r("rank"))


def q_rank_resumed(spark, sf):
    """Five steps, saved; five more from the saved vector."""
    edges = GRAPHS["part_supp"](spark, sf)
    path = _scratch(spark, "vector")
    sr.write_ranks(sr.rank(edges, epsilon=0.0, max_iter=5).ranks, path, fmt="parquet")
    return _ranks(sr.rank(edges, epsilon=0.0, max_iter=5, initial=sr.read_vector(spark, path)))


def q_saved_matrix(spark, sf):
    m, v0, _ = _first_step_parts(spark, sf)
    path = _scratch(spark, "matrix")
    m.write.parquet(path)
    return sr.multiply(sr.read_matrix(spark, path), v0).select("id", _r("y"))


def q_ranks_file_order(spark, sf):
    """Lines of the ordered rank files, numbered as they stand in the files."""
    path = _scratch(spark, "ordered")
    sr.write_ranks(sr.rank(GRAPHS["part_supp"](spark, sf), preset="script").ranks, path, ordered=True)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        F.split("value", "\t")[0].alias("id"),
    )
    sizes = lines.groupBy("file").count()
    ahead = F.coalesce(F.sum("count").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    numbered = lines.withColumn("place", place).join(sizes.select("file", ahead.alias("ahead")), "file")
    return numbered.select("id", (F.col("ahead") + F.col("place")).cast("long").alias("position"))


def q_ranks_single_file(spark, sf):
    """Lines of the one ordered rank file, numbered as they stand in it."""
    path = _scratch(spark, "single")
    sr.write_ranks(sr.rank(GRAPHS["part_supp"](spark, sf), preset="script").ranks, path, ordered=True, single_file=True)
    lines = spark.read.text(f"{path}/part-00000").select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.split("value", "\t")[0].alias("id")
    )
    sizes = lines.groupBy("block").count()
    ahead = F.coalesce(F.sum("count").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("block").orderBy("at"))
    numbered = lines.withColumn("place", place).join(sizes.select("block", ahead.alias("ahead")), "block")
    return numbered.select("id", (F.col("ahead") + F.col("place")).cast("long").alias("position"))


def q_rank_from_matrix(spark, sf):
    """Saved layout (buckets, hubs, scalars), loaded and ranked."""
    path = _scratch(spark, "layout")
    matrix = sr.LinkMatrix.build(GRAPHS["type_user"](spark, sf), hot_min_rows=1, max_hot=64)
    matrix.save(path)
    matrix.unpersist()
    loaded = sr.LinkMatrix.load(spark, path)
    res = sr.rank(matrix=loaded, preset="script")
    loaded.unpersist()
    return _ranks(res)


def q_rank_from_weights(spark, sf):
    """A saved relation (src, dst, w) ranked without its edges."""
    path = _scratch(spark, "weights")
    sr.transition_matrix(GRAPHS["part_supp"](spark, sf)).write.parquet(path)
    return _ranks(sr.rank(matrix=sr.read_matrix(spark, path), preset="cluster"))


def q_rank_reproducible(spark, sf):
    return _ranks(sr.rank(GRAPHS["part_supp"](spark, sf), preset="script", reproducible=True, num_partitions=5))


def q_rank_step_prepared(spark, sf):
    """Ten single steps over one prepared matrix."""
    matrix = sr.LinkMatrix.build(GRAPHS["cust_part"](spark, sf))
    vec = sr.initial_vector(sr.vertices(GRAPHS["cust_part"](spark, sf)), matrix.n)
    for _ in range(10):
        vec = sr.rank_step(matrix, vec, TELEPORT)
    matrix.unpersist()
    return vec.select("id", _r("rank"))


def _stopped_and_resumed(spark, sf):
    """A run that its cap ends after four steps, and one that goes on from its folder."""
    edges, path = GRAPHS["part_supp"](spark, sf), _scratch(spark, "progress")
    sr.rank(edges, preset="script", max_iter=4, progress=path)
    return sr.rank(edges, preset="script", progress=path, resume=True)


def q_rank_progress_ranks(spark, sf):
    return _ranks(_stopped_and_resumed(spark, sf))


def q_rank_progress_history(spark, sf):
    return _stopped_and_resumed(spark, sf).history.select("iteration", _r("vector_sum"), _r("l1_delta"))


def q_edges_read_report(spark, sf):
    """What one scan of an edge file with comments, blank and malformed lines counts."""
    key, path = F.col("l_partkey"), _scratch(spark, "report")
    edge = F.concat(key.cast("string"), F.lit("\t"), F.col("l_suppkey").cast("string"))
    line = (
        F.when(key % 5 == 0, key.cast("string"))
        .when(key % 5 == 1, F.lit(""))
        .when(key % 5 == 2, F.concat(F.lit("#"), edge))
        .otherwise(edge)
    )
    tables.table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    report = Observation()
    sr.read_edges(spark, path, on_malformed="drop", report=report).write.format("noop").mode("overwrite").save()
    counts = report.get
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("n", T.LongType())])
    return local_rows(spark, sorted(counts.items()), schema)


_QUERIES = {
    "vertices": q_vertices,
    "vertex_count": q_vertex_count,
    "vertex_index": q_vertex_index,
    "indexed_edges": q_indexed_edges,
    "decoded_vector": q_decoded_vector,
    "out_degree": q_out_degree,
    "edges_with_out_degree": q_edges_with_out_degree,
    "transition_matrix": q_transition_matrix,
    "transition_matrix_collapsed": q_transition_matrix_collapsed,
    "initial_vector": q_initial_vector,
    "multiply_once": q_multiply_once,
    "damped_vector": q_damped_vector,
    "vector_sum": q_vector_sum,
    "redistributed_vector": q_redistributed_vector,
    "abs_difference": q_abs_difference,
    "l1_distance": q_l1_distance,
    "rank_step": q_rank_step,
    "block_assignment": q_block_assignment,
    "block_matrix": q_block_matrix,
    "unblocked_matrix": q_unblocked_matrix,
    "rank_fixed20": q_rank_fixed20,
    "rank_script": q_rank_script,
    "rank_cluster": q_rank_cluster,
    "rank_notebook": q_rank_notebook,
    "rank_partitioned": q_rank_partitioned,
    "rank_broadcast": q_rank_broadcast,
    "rank_hubs": q_rank_hubs,
    "rank_encoded": q_rank_encoded,
    "rank_history": q_rank_history,
    "event_flow_edges": q_event_flow_edges,
    "read_write_roundtrip": q_read_write_roundtrip,
    "ranks_file_roundtrip": q_ranks_file_roundtrip,
    "rank_outcome": q_rank_outcome,
    "rank_flag_hubs": q_rank_flag_hubs,
    "edges_malformed_dropped": q_edges_malformed_dropped,
    "edges_long_ids": q_edges_long_ids,
    "rank_lookup": q_rank_lookup,
    "rank_resumed": q_rank_resumed,
    "saved_matrix": q_saved_matrix,
    "ranks_file_order": q_ranks_file_order,
    "ranks_single_file": q_ranks_single_file,
    "rank_from_matrix": q_rank_from_matrix,
    "rank_from_weights": q_rank_from_weights,
    "rank_reproducible": q_rank_reproducible,
    "rank_step_prepared": q_rank_step_prepared,
    "rank_progress_ranks": q_rank_progress_ranks,
    "rank_progress_history": q_rank_progress_history,
    "edges_read_report": q_edges_read_report,
}


# ---------------------------------------------------------------- oracle side
def _with(graph: str, body: str) -> str:
    return f"with e as ({GRAPH_SQL[graph]})\n{body}"


_MATRIX_CTES = """
pairs as (select src, dst, count(*) as copies from e group by src, dst),
deg as (select src, sum(copies) as out_degree from pairs group by src),
m as (select p.src, p.dst, p.copies::double / d.out_degree as w from pairs p join deg d on p.src = d.src),
v as (select src as id from e union select dst from e),
nv as (select count(*)::double as n from v)"""


def _walk(graph: str, teleport: float, epsilon: float, cap: int, compare_first: bool, select: str) -> str:
    """Recursive CTE ``walk(k, id, r, ys, delta)``: one row per vertex and step,
    ``ys`` = sum of the damped vector of that step, ``delta`` = L1 change
    (null where not compared).  Stops after the first step with delta < epsilon."""
    skip = 0 if compare_first else 1
    return f"""with recursive
e as ({GRAPH_SQL[graph]}),{_MATRIX_CTES},
walk(k, id, r, ys, delta) as (
  select 0, id, 1.0::double / n, null::double, null::double from v, nv
  union all
  select k, id, r, ys, case when k <= {skip} then null else sum(abs(r - prev)) over () end
  from (
    select k, id, prev, y + (1 - sum(y) over ()) / n as r, sum(y) over () as ys
    from (
      select cur.k + 1 as k, cur.id, cur.r as prev,
             (1 - {teleport!r}) * coalesce(sum(m.w * s.r), 0) as y
      from walk cur
      left join m on m.dst = cur.id
      left join walk s on s.id = m.src
      where cur.k < {cap} and (cur.delta is null or cur.delta >= {epsilon!r})
      group by cur.k, cur.id, cur.r
    ) a, nv
  ) b
)
{select}"""


_LAST = "select id, round(r, 10) as rank from walk where k = (select max(k) from walk)"


def _preset_walk(graph: str, preset: str) -> str:
    p = sr.PRESETS[preset]
    return _walk(graph, p["teleport"], p["epsilon"], p["max_iter"] or NO_CAP, p["compare_first"], _LAST)


_HISTORY = _walk(
    "part_supp",
    0.2,
    1e-4,
    300,
    False,
    "select distinct k::integer as iteration, round(ys, 10) as vector_sum, "
    "round(delta, 10) as l1_delta from walk where k >= 1",
)

_INDEX = "ix as (select id, row_number() over (order by id) - 1 as idx from (select src as id from e union select dst from e))"

_BLOCK_PARAMS = f"bp as (select count(*) as n, count(*) // {BLOCKS} as q, count(*) % {BLOCKS} as r from ix)"


def _block_expr(idx: str) -> tuple[str, str]:
    block = (
        f"cast(case when {idx} < r * (q + 1) then {idx} // (q + 1) "
        f"else r + ({idx} - r * (q + 1)) // greatest(q, 1) end as integer)"
    )
    entry = (
        f"cast(case when {idx} < r * (q + 1) then {idx} % (q + 1) "
        f"else ({idx} - r * (q + 1)) % greatest(q, 1) end as integer)"
    )
    return block, entry


def _oracles() -> dict[str, str]:
    first_step = (
        "mv as (select v.id, coalesce(sum(m.w * (1.0 / nv.n)), 0) as y "
        "from v cross join nv left join m on m.dst = v.id group by v.id)"
    )
    rb, re_ = _block_expr("ix.idx")
    drow, erow = _block_expr("di.idx")
    dcol, ecol = _block_expr("si.idx")
    raw_matrix = (
        "mr as (select e.src, e.dst, 1.0 / d.out_degree as w from e join "
        "(select src, count(*) as out_degree from e group by src) d on e.src = d.src)"
    )
    blocked = (
        f"with recursive e as ({GRAPH_SQL['raw_part_supp']}), {_INDEX}, {_BLOCK_PARAMS}, {raw_matrix}, "
        f"bm as (select {drow} as block_row, {dcol} as block_col, {erow} as entry_row, {ecol} as entry_col, mr.w "
        "from mr join ix si on si.id = mr.src join ix di on di.id = mr.dst cross join bp)"
    )
    two_steps = _walk(
        "raw_part_supp",
        TELEPORT,
        0.0,
        2,
        False,
        "select a.id, round(abs(a.r - b.r), 10) as abs_diff from walk a join walk b on a.id = b.id and a.k = 2 and b.k = 1",
    )
    return {
        "vertices": _with("page_links", "select src as id from e union select dst from e"),
        "vertex_count": _with(
            "cust_part", "select count(*)::bigint as n from (select src as id from e union select dst from e)"
        ),
        "vertex_index": f"with e as ({GRAPH_SQL['part_supp']}), {_INDEX} select id, idx from ix",
        "indexed_edges": (
            f"with e as ({GRAPH_SQL['part_supp']}), {_INDEX} "
            "select s.idx as src_idx, d.idx as dst_idx from e join ix s on s.id = e.src join ix d on d.id = e.dst"
        ),
        "decoded_vector": _preset_walk("part_supp", "script"),
        "out_degree": _with("event_flow", "select src, count(*) as out_degree from e group by src"),
        "edges_with_out_degree": _with(
            "event_flow", "select src, dst, count(*) over (partition by src) as out_degree from e"
        ),
        "transition_matrix": _with(
            "part_supp",
            "select src, dst, round(1.0 / count(*) over (partition by src), 10) as w from e",
        ),
        "transition_matrix_collapsed": f"with e as ({GRAPH_SQL['event_flow']}),{_MATRIX_CTES} "
        "select src, dst, round(w, 10) as w from m",
        "initial_vector": f"with e as ({GRAPH_SQL['page_links']}),{_MATRIX_CTES} "
        "select id, round(1.0 / n, 10) as rank from v, nv",
        "multiply_once": f"with e as ({GRAPH_SQL['part_supp']}),{_MATRIX_CTES}, {first_step} "
        "select id, round(y, 10) as y from mv",
        "damped_vector": f"with e as ({GRAPH_SQL['part_supp']}),{_MATRIX_CTES}, {first_step} "
        f"select id, round((1 - {TELEPORT!r}) * y, 10) as y from mv",
        "vector_sum": f"with e as ({GRAPH_SQL['part_supp']}),{_MATRIX_CTES}, {first_step} "
        f"select round(sum((1 - {TELEPORT!r}) * y), 10) as vector_sum from mv",
        "redistributed_vector": f"with e as ({GRAPH_SQL['part_supp']}),{_MATRIX_CTES}, {first_step}, "
        f"dv as (select id, (1 - {TELEPORT!r}) * y as y from mv) "
        "select id, round(y + (1 - (select sum(y) from dv)) / (select n from nv), 10) as rank from dv",
        "abs_difference": two_steps,
        "l1_distance": f"select round(sum(abs_diff), 10) as l1 from ({two_steps.replace('round(abs(a.r - b.r), 10)', 'abs(a.r - b.r)')})",
        "rank_step": _walk("cust_part", TELEPORT, 0.0, 1, False, _LAST),
        "block_assignment": (
            f"with e as ({GRAPH_SQL['raw_part_supp']}), {_INDEX}, {_BLOCK_PARAMS} "
            f"select ix.idx, {rb} as block, {re_} as entry from ix cross join bp"
        ),
        "block_matrix": blocked
        + " select block_row, block_col, entry_row, entry_col, round(w, 10) as w from bm",
        "unblocked_matrix": blocked
        + " select (case when block_col < r then block_col * (q + 1) else r * (q + 1) + (block_col - r) * q end"
        " + entry_col)::bigint as src_idx,"
        " (case when block_row < r then block_row * (q + 1) else r * (q + 1) + (block_row - r) * q end"
        " + entry_row)::bigint as dst_idx, round(w, 10) as w from bm cross join bp",
        "rank_fixed20": _walk("cust_part", TELEPORT, 0.0, 20, False, _LAST),
        "rank_script": _preset_walk("part_supp", "script"),
        "rank_cluster": _preset_walk("cust_part", "cluster"),
        "rank_notebook": _preset_walk("event_flow", "notebook"),
        "rank_partitioned": _preset_walk("cust_part", "script"),
        "rank_broadcast": _preset_walk("raw_part_supp", "cluster"),
        "rank_hubs": _preset_walk("type_user", "script"),
        "rank_encoded": _preset_walk("cust_part", "script"),
        "rank_history": _HISTORY,
        "rank_progress_history": _HISTORY,
        "rank_progress_ranks": _preset_walk("part_supp", "script"),
        "rank_from_matrix": _preset_walk("type_user", "script"),
        "rank_from_weights": _preset_walk("part_supp", "cluster"),
        "rank_reproducible": _preset_walk("part_supp", "script"),
        "rank_step_prepared": _walk("cust_part", TELEPORT, 0.0, 10, False, _LAST),
        "ranks_single_file": (
            f"with e as ({GRAPH_SQL['part_supp']}) select id, row_number() over (order by id) as position "
            "from (select src as id from e union select dst from e)"
        ),
        "edges_read_report": (
            "with l as (select case l_partkey % 5 when 0 then 'malformed' when 1 then 'blanks' when 2 then 'comments' "
            "else 'edges' end as kind from lineitem) "
            "select kind, count(*) as n from l group by kind union all select 'lines', count(*) from l"
        ),
        "event_flow_edges": GRAPH_SQL["event_flow"],
        "read_write_roundtrip": GRAPH_SQL["page_links"],
        "ranks_file_roundtrip": _preset_walk("raw_part_supp", "script"),
        "rank_flag_hubs": _preset_walk("flag_order", "script"),
        "rank_outcome": _walk(
            "type_user",
            SLOW_TELEPORT,
            sr.PRESETS["cluster"]["epsilon"],
            NO_CAP,
            True,
            "select max(k)::integer as iterations, min(delta) < 1e-5 as converged from walk",
        ),
        "edges_malformed_dropped": (
            "select case when l_partkey % 7 = 1 then '' else l_partkey::varchar end as src, l_suppkey::varchar as dst "
            "from lineitem where l_partkey % 7 not in (0, 2)"
        ),
        "edges_long_ids": GRAPH_SQL["raw_part_supp"],
        "rank_lookup": _preset_walk("raw_part_supp", "script") + " and id in (select s_suppkey from supplier)",
        "rank_resumed": _walk("part_supp", TELEPORT, 0.0, 10, False, _LAST),
        "saved_matrix": f"with e as ({GRAPH_SQL['part_supp']}),{_MATRIX_CTES}, {first_step} "
        "select id, round(y, 10) as y from mv",
        "ranks_file_order": (
            f"with e as ({GRAPH_SQL['part_supp']}) select id, row_number() over (order by id) as position "
            "from (select src as id from e union select dst from e)"
        ),
    }


# ---------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rank the part -> supplier graph of sf0.001 with preset "script"."""
    return q_rank_script(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {**corpus.QUERIES, "pipeline": corpus_pipeline.run} if corpus else {}
    return {**_QUERIES, **more}


def oracle_sql() -> dict[str, str]:
    more = dict(corpus.ORACLES) if corpus else {}
    if corpus and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**_oracles(), **more}
