"""Column expressions for a balanced contiguous split of ``0 .. n-1`` into ``d`` blocks.

With ``q = n div d`` and ``r = n mod d`` the first ``r`` blocks hold
``q + 1`` indexes and the remaining ``d - r`` hold ``q``.  Everything is a
closed form on the index column, so no window or global ordering is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2**31 - 1


def _split(n: int, d: int) -> tuple[int, int, int]:
    if d <= 0:
        raise ValueError("number of blocks must be positive")
    if n < 0:
        raise ValueError("n must be non-negative")
    q, r = divmod(n, d)
    if max(d, q + 1) > INT_MAX:
        raise ValueError("block and entry numbers must fit 32 bits")
    return q, r, r * (q + 1)


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def block_of(idx: Column, n: int, d: int) -> Column:
    """Block number (0-based int) of a dense index."""
    q, r, boundary = _split(n, d)
    big = _div(idx, q + 1)
    small = F.lit(r) + _div(idx - F.lit(boundary), max(q, 1))
    return F.when(idx < F.lit(boundary), big).otherwise(small).cast("int")


def offset_in_block(idx: Column, n: int, d: int) -> Column:
    """Position of a dense index inside its block (0-based int)."""
    q, r, boundary = _split(n, d)
    big = F.pmod(idx, F.lit(q + 1))
    small = F.pmod(idx - F.lit(boundary), F.lit(max(q, 1)))
    return F.when(idx < F.lit(boundary), big).otherwise(small).cast("int")


def block_start(block: Column, n: int, d: int) -> Column:
    """First dense index of a block (bigint)."""
    q, r, boundary = _split(n, d)
    big = block.cast("long") * F.lit(q + 1)
    small = F.lit(boundary) + (block.cast("long") - F.lit(r)) * F.lit(q)
    return F.when(block < F.lit(r), big).otherwise(small).cast("long")


def index_of(block: Column, offset: Column, n: int, d: int) -> Column:
    """Dense index from block and offset (inverse of ``block_of``/``offset_in_block``)."""
    return (block_start(block, n, d) + offset.cast("long")).cast("long")
