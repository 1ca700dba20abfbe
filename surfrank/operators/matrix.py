"""Transition matrix and vector operators.

Relations:

* matrix ``(src, dst, w)``: ``w`` is the chance of stepping from ``src``
  to ``dst``; each non-sink source's weights sum to 1;
* vector ``(id, <value>)``: exactly one row per vertex.

One step of the random surfer (``rank_step``) is
``y = (1 - t) * M v`` followed by ``v' = y + (1 - sum(y)) / n``: the
teleport share and the mass that disappears in sinks are spread evenly
over all vertices, so every ``v'`` sums to 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.exact import exact_sum
from ..functions.skew import salted_join, split_join
from ..plans.layout import LinkMatrix
from ..session import checkpoint_dir, tracked
from ..sources.edges import complete_edges
from .graph import degree_hot_keys, with_out_degree


def transition_matrix(edges: DataFrame, collapse: bool = True, max_hot: int | None = None) -> DataFrame:
    """Sparse transition matrix ``(src, dst, w)`` (A3, A4).

    ``collapse=False`` gives one entry per edge row, ``w = 1/out_degree``.
    ``collapse=True`` merges equal coordinates: ``w = copies/out_degree``,
    the same matrix with fewer rows.  Partial aggregation does most of the
    merging before any shuffle; hub sources join their degree in pieces.
    """
    edges = complete_edges(edges)
    if not collapse:
        return with_out_degree(edges, max_hot).select(
            "src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("w")
        )
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    deg = pairs.groupBy("src").agg(F.sum("copies").alias("out_degree"))
    hot = degree_hot_keys(deg, "src", "out_degree", max_hot)
    return salted_join(pairs, deg, "src", hot).select(
        "src", "dst", (F.col("copies") / F.col("out_degree")).cast("double").alias("w")
    )


def initial_vector(verts: DataFrame, n: int | None = None) -> DataFrame:
    """Uniform start vector ``(id, rank = 1/n)`` over all vertices."""
    if n is None:
        n = verts.count()
    if n == 0:
        return verts.select("id", F.lit(None).cast("double").alias("rank")).limit(0)
    return verts.select("id", F.lit(1.0 / n).alias("rank"))


def multiply(
    matrix: DataFrame | LinkMatrix, vec: DataFrame, value: str = "rank", hot: DataFrame | str | None = "auto"
) -> DataFrame:
    """``y = M v`` as ``(id, y)``, one row per id of ``vec``.

    Each matrix entry meets its source's vector entry (equi-join on the
    source), the products are summed per target (partial sums before the
    shuffle), and the vector's own ids are added with 0 so that a vertex
    without in-links still gets its row.

    A ``LinkMatrix`` is the prepared form for repeated products: counts, hubs and
    layout were made once.  For a relation, ``hot`` says how hub sources are
    spread: ``"auto"`` finds them in the same plan from the matrix (``salted_join``),
    a DataFrame gives them (their entries join a broadcast copy of their vector
    entries), ``None`` turns the split off.
    """
    if isinstance(matrix, LinkMatrix):
        return matrix.multiply(vec, value)
    entries = matrix.select("src", "dst", "w")
    src_vals = vec.select(F.col("id").alias("src"), F.col(value).alias("_x"))
    if isinstance(hot, str):
        counts = entries.groupBy("src").agg(F.count(F.lit(1)).alias("_entries"))
        met = salted_join(entries, src_vals, "src", degree_hot_keys(counts, "src", "_entries"))
    else:
        met = split_join(entries, src_vals, "src", hot)
    contrib = met.select(F.col("dst").alias("id"), (F.col("w") * F.col("_x")).alias("_c"))
    base = vec.select("id", F.lit(0.0).alias("_c"))
    return contrib.unionByName(base).groupBy("id").agg(F.sum("_c").alias("y"))


def damp(vec: DataFrame, teleport: float, value: str = "y") -> DataFrame:
    """Scale every entry by ``1 - teleport``."""
    return vec.select("id", (F.lit(1.0 - teleport) * F.col(value)).alias(value))


def vector_sum(vec: DataFrame, value: str = "y") -> DataFrame:
    """Sum of a vector as a one-row DataFrame ``(vector_sum)`` (A5), the same bits for any partitioning."""
    return vec.agg(exact_sum(F.col(value)).alias("vector_sum"))


def redistribute(vec: DataFrame, n: int, total: float, value: str = "y", out: str = "rank") -> DataFrame:
    """Add the missing mass evenly: ``value + (1 - total) / n``.

    ``total`` is the vector's sum (``vector_sum``), read once on the driver
    and used as a literal, so the projection stays inside generated code.
    """
    shift = (1.0 - total) / n
    return vec.select("id", (F.col(value) + F.lit(shift)).alias(out))


def abs_difference(a: DataFrame, b: DataFrame, value: str = "rank") -> DataFrame:
    """Per-vertex ``|a - b|`` over the union of ids: ``(id, abs_diff)``.

    A missing side counts as 0.  Keys are unique on both sides.
    """
    left = a.select("id", F.col(value).alias("_a"))
    right = b.select("id", F.col(value).alias("_b"))
    return left.join(right, "id", "full").select(
        "id", F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))).alias("abs_diff")
    )


def l1_distance(a: DataFrame, b: DataFrame, value: str = "rank") -> DataFrame:
    """Sum of absolute differences as a one-row DataFrame ``(l1)`` (A6), the same bits for any partitioning."""
    return abs_difference(a, b, value).agg(exact_sum(F.col("abs_diff")).alias("l1"))


def rank_step(
    matrix: DataFrame | LinkMatrix,
    vec: DataFrame,
    teleport: float,
    n: int | None = None,
    hot: DataFrame | str | None = "auto",
) -> DataFrame:
    """One full step: multiply, damp, redistribute (V7).  Returns ``(id, rank)``.

    ``n`` is the number of vertices; a ``LinkMatrix`` knows it.  Runs one job:
    it writes the damped vector as a reliable checkpoint and observes its sum, and
    the returned vector reads the written result.
    """
    if n is None:
        if not isinstance(matrix, LinkMatrix):
            raise ValueError("a step over a plain matrix needs the number of vertices")
        n = matrix.n
    checkpoint_dir(vec.sparkSession)
    told = Observation()
    damped = damp(multiply(matrix, vec, "rank", hot), teleport, "y")
    y = tracked(damped.observe(told, exact_sum(F.col("y")).alias("total")).checkpoint(eager=True))
    return redistribute(y, n, float(told.get["total"] or 0.0), "y", "rank")


__all__ = [
    "abs_difference",
    "damp",
    "initial_vector",
    "l1_distance",
    "multiply",
    "rank_step",
    "redistribute",
    "transition_matrix",
    "vector_sum",
]
