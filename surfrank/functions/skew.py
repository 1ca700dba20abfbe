"""Skew handling for equi-joins on a vertex key.

A single page may own a large share of all edges (a hub).  A plain shuffle
join on that page's key sends all its rows to one task.  The helpers here
split such keys:

* ``hot_pieces`` picks, as a relation of the same plan, the keys whose row count
  is at least ``total / max_hot``, with the number of pieces that brings each
  piece below that bar.  At most ``max_hot`` keys can pass, and their pieces are
  at most ``2 * max_hot``, so the relation has a proven size bound and may be
  broadcast.  The total is a scalar subquery over the same count table: no job
  runs before the caller's action, nothing is collected.
* ``salted_join`` joins on the key and a piece number: a hot key's rows are dealt
  over its pieces, its single dimension row is copied once for each.
* ``split_join`` joins the cold rows with an ordinary (shuffle) join and the hot
  rows against a broadcast copy of the matching dimension rows, which leaves the
  hot rows where they are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_HOT = 1024
_PIECES, _PIECE = "_surfrank_pieces", "_surfrank_piece"


def hot_threshold(total_rows: int, max_hot: int = DEFAULT_MAX_HOT, min_rows: int = 1) -> int:
    """Row count from which a key is treated as hot (at most ``max_hot`` keys reach it)."""
    return max(int(min_rows), int(math.ceil(total_rows / max(int(max_hot), 1))), 1)


def hot_pieces(counts: DataFrame, key: str, count_col: str, max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """``(key, pieces)`` of the hot keys of a count table (bounded, see module doc)."""
    counts = counts.filter(F.col(key).isNotNull())  # as the joins below see it, so that all read one exchange
    total = counts.agg(F.sum(count_col)).scalar()
    bar = F.greatest(F.ceil(total / F.lit(max(int(max_hot), 1))), F.lit(1))
    return counts.filter(F.col(count_col) >= bar).select(key, F.ceil(F.col(count_col) / bar).cast("int").alias(_PIECES))


def salted_join(big: DataFrame, dim: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``big`` join ``dim`` on ``key`` (same name on both sides, unique in ``dim``), hot keys in pieces.

    ``hot`` is a result of ``hot_pieces``.  A row's piece follows from its values
    and its partition, so a repeated task deals its rows out alike and equal rows
    of several partitions part.  ``how`` is ``"inner"`` or ``"left"``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    pieces = F.broadcast(hot)
    at = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]) + F.spark_partition_id(), F.col(_PIECES)).cast("int")
    dealt = big.join(pieces, key, "left").withColumn(_PIECE, F.coalesce(at, F.lit(0))).drop(_PIECES)
    copies = (
        dim.join(pieces, key, "left")
        .withColumn(_PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)))
        .drop(_PIECES)
    )
    return dealt.join(copies, [key, _PIECE], how).drop(_PIECE)


def split_join(
    big: DataFrame,
    dim: DataFrame,
    key: str,
    hot: DataFrame | None,
    how: str = "inner",
) -> DataFrame:
    """``big`` join ``dim`` on ``key`` (same name on both sides), hot keys broadcast.

    ``hot`` holds the hot key values, at most a bounded number of rows, and
    ``key`` must be unique in ``dim`` (a degree table, a dictionary): then the
    broadcast part of ``dim`` has at most as many rows as ``hot``.
    ``how`` is ``"inner"`` or ``"left"`` (all rows of ``big`` kept).
    With ``hot=None`` this is a plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if hot is None:
        return big.join(dim, key, how)
    hot_b = F.broadcast(hot.select(key).distinct())
    cold = big.join(hot_b, key, "left_anti").join(dim, key, how)
    hot_dim = dim.join(hot_b, key, "left_semi")
    warm = big.join(hot_b, key, "left_semi").join(F.broadcast(hot_dim), key, how)
    return cold.unionByName(warm)
