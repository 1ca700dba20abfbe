"""Skew-safe "next row of the same key" (the ``lead`` of a key-partitioned window).

``Window.partitionBy(key)`` hands every row of one key to one task, which
is what a hot key must not do.  Here the rows are cut into ranges of
``(key, order...)``, so a hot key's run falls into several ranges.  The
bounds of the ranges are drawn once (from a bounded sample, picked by a hash
of the rows) and become literals of the plan, so a row's range is a function
of the row alone.  One hash exchange on ``(range, key)`` brings the groups
together; the window runs inside them.  The last row of a group takes its
successor from the first row of the next range that has rows, via a table
with one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

SAMPLE_PER_RANGE = 20


def range_bounds(df: DataFrame, cols: list[str], parts: int) -> list:
    """At most ``parts - 1`` increasing rows of ``cols`` that cut ``df`` into even ranges."""
    sample = df.select(*cols).orderBy(F.xxhash64(*cols), *cols).limit(SAMPLE_PER_RANGE * parts)
    rows = sample.orderBy(*cols).collect()
    picked = [rows[i * len(rows) // parts] for i in range(1, parts)] if rows else []
    return [r for i, r in enumerate(picked) if i == 0 or r != picked[i - 1]]


def range_of(cols: list[str], bounds: list, schema) -> Column:
    """How many of ``bounds`` are at or below the row (binary search)."""
    if not bounds:
        return F.lit(0)
    kinds = [schema[c].dataType for c in cols]
    known = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(cols, b, kinds)]) for b in bounds])
    row = F.struct(*cols)
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])

    def closer(low: Column, step: Column) -> Column:
        return F.when((low + step <= len(bounds)) & (F.get(known, low + step - 1) <= row), low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), closer)


def with_next(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    out: str = "next_value",
    num_partitions: int | None = None,
) -> DataFrame:
    """All rows of ``df[key, *order, value]`` plus ``out``: ``value`` of the next row
    with the same ``key`` in ``order`` (null for the last row of a key).

    ``order`` must make rows of one key unique (add a unique id as tie-break).
    """
    parts = num_partitions or shuffle_partitions(df.sparkSession)
    cols = [key, *order]
    bounds = range_bounds(df, cols, parts)
    ranged = df.select(key, *order, value).withColumn("_range", range_of(cols, bounds, df.schema))
    group = Window.partitionBy("_range", key).orderBy(*order)
    local = ranged.select(
        "*",
        F.lead(value).over(group).alias("_local_next"),
        F.lead(F.lit(True)).over(group).isNull().alias("_is_last"),
    )
    firsts = ranged.groupBy("_range").agg(
        F.min(F.struct(*[F.col(c) for c in cols], F.col(value).alias("_v"))).alias("_first")
    )
    following = firsts.select(
        "_range",
        F.lead("_first").over(Window.orderBy("_range")).alias("_following"),
    )
    joined = local.join(F.broadcast(following), "_range", "left")
    successor = F.when(
        F.col("_is_last") & (F.col(f"_following.{key}") == F.col(key)),
        F.col("_following._v"),
    ).otherwise(F.col("_local_next"))
    return joined.select(key, *order, value, successor.alias(out))
