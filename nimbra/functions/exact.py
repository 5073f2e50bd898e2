"""Arithmetic whose result does not depend on row order or on the engine.

Sums are taken over decimals of ten places, more than readings carry, so they are
associative and keep small amounts; a value that does not fit fails loudly (ANSI
mode) instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"


def round_half_away(x: Column, digits: int) -> Column:
    """Round half away from zero on the double itself; null stays null."""
    scale = float(10**digits)
    half = F.lit(0.5)
    return (
        F.when(x < 0, -F.floor(-x * F.lit(scale) + half)).otherwise(
            F.floor(x * F.lit(scale) + half)
        )
        / F.lit(scale)
    )


def exact_sum(x: Column) -> Column:
    return F.sum(x.cast(EXACT)).cast("double")


def exact_avg(x: Column) -> Column:
    """Mean of non-null values; null when there are none."""
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0).cast("bigint"))


def exact_avg_over(x: Column, window) -> Column:
    total = F.sum(x.cast(EXACT)).over(window).cast("double")
    return total / F.nullif(F.count(x).over(window), F.lit(0).cast("bigint"))
