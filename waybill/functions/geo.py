"""Distances between coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.fixed_values import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; NULL when any coordinate is missing."""
    half_chord = (
        F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2)
        + F.cos(F.radians(lat1))
        * F.cos(F.radians(lat2))
        * F.pow(F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2)
    )
    # Rounding can push antipodal points above 1, outside asin's domain.
    bounded = F.when(half_chord > 1, F.lit(1.0)).otherwise(half_chord)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(bounded))


def euclid_degrees(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Straight-line distance in degrees, a rough first look only."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lng1 - lng2, 2))
