"""Great-circle distance and coordinate guards as Column expressions."""

from __future__ import annotations

from functools import reduce
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used by every distance variant.
EARTH_RADIUS_KM = 6371.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finite(c: Column) -> Column:
    """False for NaN and infinities (NaN ranks above every number)."""
    return F.abs(c) < F.lit(float("inf"))


def _haversine_term(lat1: Column, lon1: Column, lat2: Column, lon2: Column, clamp: bool) -> Column:
    """The haversine ``a`` term: sin^2(dlat/2) + cos(lat1) cos(lat2) sin^2(dlon/2);
    null when a coordinate is null or not finite."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    if clamp:
        # Rounding can push ``a`` a hair above 1 for antipodal points; sqrt(1 - a)
        # and asin(sqrt(a)) would then give NaN, which sorts above every distance.
        a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.when(reduce(lambda x, y: x & y, map(_finite, (lat1, lon1, lat2, lon2))), a)


def haversine_km_atan2(lat1, lon1, lat2, lon2, clamp: bool = True) -> Column:
    """Distance in km, ``R * 2 * atan2(sqrt(a), sqrt(1 - a))`` form."""
    a = _haversine_term(_col(lat1), _col(lon1), _col(lat2), _col(lon2), clamp)
    return F.lit(EARTH_RADIUS_KM) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def haversine_km_asin(lat1, lon1, lat2, lon2, clamp: bool = True) -> Column:
    """Distance in km, ``R * 2 * asin(sqrt(a))`` form."""
    a = _haversine_term(_col(lat1), _col(lon1), _col(lat2), _col(lon2), clamp)
    return F.lit(EARTH_RADIUS_KM * 2) * F.asin(F.sqrt(a))


def km_at_most(lat1, lon1, lat2, lon2) -> Column:
    """No less than the distance, and cheap: first along the meridian, then along the parallel."""
    degrees = F.abs(_col(lat2) - _col(lat1)) + F.abs(_col(lon2) - _col(lon1))
    return degrees * F.lit(EARTH_RADIUS_KM * pi / 180 * (1 + 1e-9)) + F.lit(1e-6)  # above any rounding


def nonzero_points(*coords: str | Column) -> Column:
    """True when every coordinate is non-zero; a null coordinate makes it null (row drops)."""
    return reduce(lambda acc, c: acc & c, [_col(c) != 0 for c in coords])
