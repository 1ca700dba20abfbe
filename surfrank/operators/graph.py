"""Vertex set, dictionary and degree operators (D-1 .. D-5, A1, A2).

Edges are ``(src, dst)`` with ids of any orderable type.  A vertex is an
id that occurs at either end of at least one edge; gaps in a numeric range
are not vertices.  Duplicate edge rows count (out-degree counts rows) and
self-links are ordinary edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import DEFAULT_MAX_HOT, hot_pieces, salted_join
from ..session import checkpoint_dir, shuffle_partitions, tracked


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct ids of both columns: ``(id)`` (D-1).

    Union then distinct: each task drops its own duplicates before the
    shuffle, so a hub costs one row per task, not one per edge.
    """
    return (
        edges.select(F.col("src").alias("id"))
        .union(edges.select(F.col("dst").alias("id")))
        .distinct()
    )


def vertex_table(edges: DataFrame) -> DataFrame:
    """Vertices with their out-degree (0 for sinks): ``(id, out_degree)``.

    One aggregation over the edge rows tagged by end; partial aggregation
    keeps hubs cheap.
    """
    tagged = edges.select(F.col("src").alias("id"), F.lit(1).cast("long").alias("o")).union(
        edges.select(F.col("dst").alias("id"), F.lit(0).cast("long").alias("o"))
    )
    return tagged.groupBy("id").agg(F.sum("o").alias("out_degree"))


def vertex_count(edges: DataFrame) -> DataFrame:
    """Number of vertices as a one-row DataFrame ``(n)`` (D-2)."""
    return vertices(edges).agg(F.count(F.lit(1)).cast("long").alias("n"))


def count_vertices(edges: DataFrame) -> int:
    return int(vertex_count(edges).collect()[0]["n"])


def vertex_index(edges: DataFrame, num_partitions: int | None = None, from_vertices: bool = False) -> DataFrame:
    """Dense 0-based numbering of the vertices in id order: ``(id, idx bigint)`` (D-3).

    The ids are range-partitioned and sorted, then written as a reliable
    checkpoint so that the two passes below see the same partitions.  Each
    task numbers its rows from a per-task offset; the offsets come from a
    running sum over the per-task counts (one row per task).  No step puts
    all ids into one task.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    parts = num_partitions or shuffle_partitions(spark)
    ids = edges.select("id") if from_vertices else vertices(edges)
    ranged = tracked(ids.repartitionByRange(parts, "id").sortWithinPartitions("id").checkpoint(eager=True))
    numbered = ranged.select(
        "id",
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    counts = numbered.groupBy("_task").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first_mid")
    )
    offsets = counts.select(
        "_task",
        "_first_mid",
        (
            F.coalesce(
                F.sum("_rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            )
        ).alias("_offset"),
    )
    return numbered.join(F.broadcast(offsets), "_task").select(
        "id", (F.col("_offset") + F.col("_mid") - F.col("_first_mid")).cast("long").alias("idx")
    )


def out_degree(edges: DataFrame) -> DataFrame:
    """Out-degree per source, duplicates counted: ``(src, out_degree)`` (A1)."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).cast("long").alias("out_degree"))


def degree_hot_keys(counts: DataFrame, key: str, count_col: str, max_hot: int | None = None) -> DataFrame:
    """Hot keys of a count table and their pieces, as a relation of the caller's plan (``hot_pieces``).

    ``max_hot`` defaults to twice the session's shuffle partitions (1024 at
    least), so a key below the bar holds at most half an average partition.
    """
    if max_hot is None:
        max_hot = max(DEFAULT_MAX_HOT, 2 * shuffle_partitions(counts.sparkSession))
    return hot_pieces(counts, key, count_col, max_hot)


def with_out_degree(edges: DataFrame, max_hot: int | None = None) -> DataFrame:
    """Every edge row with its source's out-degree: ``(src, dst, out_degree)`` (A2).

    The value of a whole-partition ``count(*) over (partition by src)``,
    computed as A1 plus a join so that a hub's rows are not one window
    group; the rows of a hub source are joined in pieces.
    """
    deg = out_degree(edges)
    hot = degree_hot_keys(deg, "src", "out_degree", max_hot)
    return salted_join(edges.select("src", "dst"), deg, "src", hot).select("src", "dst", "out_degree")


def index_edges(edges: DataFrame, index: DataFrame, max_hot: int | None = None) -> DataFrame:
    """Edges rewritten to dense ids: ``(src_idx, dst_idx)``, one row per edge row (D-4)."""
    src_hot = degree_hot_keys(out_degree(edges), "src", "out_degree", max_hot)
    in_deg = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("in_degree"))
    dst_hot = degree_hot_keys(in_deg, "dst", "in_degree", max_hot)
    by_src = salted_join(
        edges.select("src", "dst"), index.select(F.col("id").alias("src"), F.col("idx").alias("src_idx")), "src", src_hot
    )
    both = salted_join(
        by_src, index.select(F.col("id").alias("dst"), F.col("idx").alias("dst_idx")), "dst", dst_hot
    )
    return both.select("src_idx", "dst_idx")


def decode_vector(vec: DataFrame, index: DataFrame, value: str = "rank") -> DataFrame:
    """Dense-id vector ``(idx, value)`` back to original ids ``(id, value)`` (D-5).

    Both sides have unique keys, so the join cannot be skewed.
    """
    return vec.join(index, "idx").select("id", value)


def lookup(vec: DataFrame, ids: DataFrame) -> DataFrame:
    """Entries of ``vec`` for the ids in ``ids(id)`` (D-6), as a semi join."""
    return vec.join(ids.select("id"), "id", "left_semi")
