"""Block layout of dense ids and of the transition matrix.

Rows of the matrix are targets, columns are sources, as in ``y = M v``.
All three operators are projections with closed-form expressions: no
shuffle, no window, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import block_of, index_of, offset_in_block
from ..functions.skew import salted_join
from .graph import degree_hot_keys


def assign_block(index: DataFrame, n: int, d: int, idx: str = "idx") -> DataFrame:
    """``(idx, block, entry)`` for dense ids ``0..n-1`` split into ``d`` blocks (B1)."""
    col = F.col(idx)
    return index.select(
        col.alias("idx"), block_of(col, n, d).alias("block"), offset_in_block(col, n, d).alias("entry")
    )


def index_matrix(matrix: DataFrame, index: DataFrame) -> DataFrame:
    """Matrix with dense ids: ``(src_idx, dst_idx, w)``; keys of ``index`` are unique."""
    src_counts = matrix.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    dst_counts = matrix.groupBy("dst").agg(F.count(F.lit(1)).alias("_n"))
    by_src = salted_join(
        matrix.select("src", "dst", "w"),
        index.select(F.col("id").alias("src"), F.col("idx").alias("src_idx")),
        "src",
        degree_hot_keys(src_counts, "src", "_n"),
    )
    both = salted_join(
        by_src,
        index.select(F.col("id").alias("dst"), F.col("idx").alias("dst_idx")),
        "dst",
        degree_hot_keys(dst_counts, "dst", "_n"),
    )
    return both.select("src_idx", "dst_idx", "w")


def block_matrix(indexed: DataFrame, n: int, d: int) -> DataFrame:
    """Blocked matrix ``(block_row, block_col, entry_row, entry_col, w)`` (B2).

    Row coordinates come from the target, column coordinates from the source.
    """
    dst, src = F.col("dst_idx"), F.col("src_idx")
    return indexed.select(
        block_of(dst, n, d).alias("block_row"),
        block_of(src, n, d).alias("block_col"),
        offset_in_block(dst, n, d).alias("entry_row"),
        offset_in_block(src, n, d).alias("entry_col"),
        "w",
    )


def unblock(blocked: DataFrame, n: int, d: int) -> DataFrame:
    """Blocked matrix back to ``(src_idx, dst_idx, w)``."""
    return blocked.select(
        index_of(F.col("block_col"), F.col("entry_col"), n, d).alias("src_idx"),
        index_of(F.col("block_row"), F.col("entry_row"), n, d).alias("dst_idx"),
        "w",
    )
