"""Rounding to three decimals as the exact binary value demands, in double arithmetic alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = 134217729.0  # 2 ** 27 + 1: Veltkamp's splitting of a double into two halves


def round3(x: Column) -> Column:
    """x to the nearest multiple of 0.001, ties by the exact value of x and then to even.

    The product x * 1000 is itself rounded; where it lands on a tie the rounding error, recovered by splitting x,
    says on which side the exact product lies. x is bound once: roundings of roundings would else unfold to expressions
    of hundreds of nodes when projections are merged.
    """

    def rounded(v: Column) -> Column:
        p = v * F.lit(1000.0)
        high = v * F.lit(SPLIT) - (v * F.lit(SPLIT) - v)
        error = (high * F.lit(1000.0) - p) + (v - high) * F.lit(1000.0)
        tie = p - F.floor(p) == F.lit(0.5)
        return F.when(tie & (error > 0), F.ceil(p).cast("double")).when(tie & (error < 0), F.floor(p).cast("double")).otherwise(F.rint(p)) / F.lit(1000.0)

    return F.element_at(F.transform(F.array(x), rounded), 1)


def milliseconds(x: Column) -> Column:
    """A rounded second as whole milliseconds, for sums that do not depend on their order."""
    return F.rint(x * F.lit(1000.0)).cast("long")
