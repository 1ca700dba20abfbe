"""Connected components of an edge list by alternating star contractions.

Each round links every node's larger neighbours to its smallest neighbour
(large star), then its smaller ones (small star), until nothing changes;
then every node hangs from the smallest of its component.  A round is two
aggregations with map-side minimum and two joins on the edge list; rounds
are cut by reliable checkpoints.  Nothing is collected but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not the smallest of its component."""
    now = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    told = None
    while True:
        new = cut(_small_star(_large_star(now)))
        row = new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(row) == told:
            return new.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now, told = new, tuple(row)
