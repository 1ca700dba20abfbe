"""Sums of doubles that do not depend on the order of their terms.

Every double is cut into limbs, whole numbers of falling binary weight.  A limb
is exact (scaling by a power of two and taking the floor lose nothing), sums of
whole numbers are the same in any order and grouping, and the limb sums are put
together at the end.  So a sum has the same bits for 1 or 1000 partitions, before
and after a retried task.  Only what lies below the last weight is cut off, from
each term alone.

``weights`` are the exponents of the limbs.  ``UNIT`` fits terms whose absolute
values sum to less than 4: 61 bits, then 22 more, so up to 2^41 terms fit and each
loses less than 2^-83.  ``WIDE`` fits terms of any size below 2^63 over the number
of terms: the whole part and four limbs of 20 bits, up to 2^43 terms.  A sum
outside these ranges fails under ANSI mode (overflow), it never wraps silently
there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = (61, 83)
WIDE = (0, 20, 40, 60, 80)


def unit_weights(norm: float) -> tuple[int, ...]:
    """``UNIT`` moved up so that absolute values may sum to less than ``4 * norm``."""
    extra = max(0, math.ceil(math.log2(norm))) if norm > 1 else 0
    return tuple(w - extra for w in UNIT)


def limbs_sql(value: str, weights: tuple[int, ...] = UNIT) -> list[str]:
    """SQL of the limbs (bigint) of the double expression ``value``."""
    out, rest, last = [], f"({value})", 0
    for weight in weights:
        scaled = f"({rest} * {2.0 ** (weight - last)!r}D)"
        out.append(f"floor({scaled})")
        rest, last = f"({scaled} - floor({scaled}))", weight
    return out


def joined_sql(sums: list[str], weights: tuple[int, ...] = UNIT) -> str:
    """SQL of the double that limb sums stand for."""
    return "(" + " + ".join(f"cast({s} as double) * {2.0 ** -w!r}D" for s, w in zip(sums, weights, strict=True)) + ")"


def exact_sum(value: Column, weights: tuple[int, ...] = WIDE) -> Column:
    """Aggregate: the sum of ``value`` (null terms are left out, null without terms)."""
    total, rest, last = None, value, 0
    for weight in weights:
        scaled = rest * F.lit(2.0 ** (weight - last))
        part = F.sum(F.floor(scaled)).cast("double") * F.lit(2.0**-weight)
        total = part if total is None else total + part
        rest, last = scaled - F.floor(scaled), weight
    return total
