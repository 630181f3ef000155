"""Bin numbers: one rule for all the ways of closing an interval."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_index(x: Column, edges: list[float], closed: str = "left", keep_ends: bool = False) -> Column:
    """0-based bin of x among edges; null outside.

    closed "left" is [a, b), "right" is (a, b]. keep_ends puts the last edge (left) or the first one (right) inside.
    """
    marks = [F.lit(float(e)) for e in edges]
    if closed == "left":
        i = sum((F.when(x >= m, 1).otherwise(0) for m in marks), F.lit(-1))
        inside = (x >= marks[0]) & (x < marks[-1])
        top = x == marks[-1]
    else:
        i = sum((F.when(x > m, 1).otherwise(0) for m in marks), F.lit(-1))
        inside = (x > marks[0]) & (x <= marks[-1])
        top = x == marks[0]
    out = F.when(inside, i)
    if keep_ends:
        out = out.when(top, len(edges) - 2 if closed == "left" else 0)
    return out.cast("int")


def inner_bin(x: Column, inner_edges: list[float]) -> Column:
    """Bins by the internal edges only, so that nothing falls out; non-positive values have bin 0."""
    i = sum((F.when(x >= F.lit(float(e)), 1).otherwise(0) for e in inner_edges), F.lit(0))
    return F.when(x <= 0, 0).otherwise(i).cast("int")


def log_edges(low: float, high: float, bins: int) -> list[float]:
    """bins + 1 edges at equal distances of the logarithm."""
    return [math.exp(math.log(low) + (math.log(high) - math.log(low)) * i / bins) for i in range(bins + 1)]
