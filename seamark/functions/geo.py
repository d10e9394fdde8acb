"""Positions on the sphere, in degrees and kilometres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_DIAMETER_KM = 12742.0
KM_PER_DEGREE = EARTH_DIAMETER_KM * 3.141592653589793 / 360


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = (
        0.5
        - F.cos(F.radians(lat2 - lat1)) / 2
        + F.cos(F.radians(lat1))
        * F.cos(F.radians(lat2))
        * (1 - F.cos(F.radians(lon2 - lon1)))
        / 2
    )
    # Rounding may leave [0, 1] by a hair; missing positions stay missing.
    half = F.when(half < 0, 0.0).when(half > 1, 1.0).otherwise(half)
    return EARTH_DIAMETER_KM * F.asin(F.sqrt(half))


def haversine(km: float) -> float:
    """The squared half chord that belongs to a distance."""
    return math.sin(min(km / EARTH_DIAMETER_KM, math.pi / 2)) ** 2


def west_negative(lon: Column) -> Column:
    """0..360 longitudes to -180..180; values up to 180 stay."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def wrap_longitude(lon: Column) -> Column:
    """Fold any longitude into [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180
