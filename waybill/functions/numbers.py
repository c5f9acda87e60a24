"""Small numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with NULL, not an error, for a zero denominator."""
    return top / F.nullif(bottom, F.lit(0))


def zero_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with 0 for a zero denominator (the metric convention)."""
    return F.coalesce(safe_ratio(top, bottom), F.lit(0.0))


def percent(top: Column, bottom: Column, digits: int) -> Column:
    return F.round(100.0 * safe_ratio(top, bottom), digits)


def grid_position(value: Column, grid: Sequence[float]) -> Column:
    """How many points of an ascending grid are <= ``value``."""
    position = F.lit(0)
    for point in grid:
        position = position + (value >= F.lit(float(point))).cast("int")
    return position


def ordered_bucket(value: Column, mantissa_bits: int) -> Column:
    """A long that never decreases as the double ``value`` grows.

    Buckets follow the binary magnitude, so they adapt to any value range
    without looking at the data first: about ``2 ** mantissa_bits`` buckets
    per power of two, mirrored for negative numbers.
    """
    per_octave = 1 << mantissa_bits
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    within = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * per_octave)
    within = F.greatest(F.lit(0), F.least(F.lit(per_octave - 1), within))
    magnitude = (octave + 1100) * per_octave + within + 1
    return (
        F.when(size == 0, F.lit(0))
        .when(value > 0, magnitude)
        .otherwise(-magnitude)
        .cast("long")
    )
