"""Coordinate Column expressions: detect a swapped (lat, lon) pair, null out of range.

All bounds are inclusive. NULL inputs propagate through three-valued logic:
a NULL "inverted" flag means "do not swap". NaN compares greater than every
number in Spark, so NaN is out of range on the upper side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import as_col

# Absolute latitude and longitude bounds.
LAT_BOUND = 90
LON_BOUND = 180


def outside(c, bound: float) -> Column:
    """``c < -bound OR c > bound``."""
    c = as_col(c)
    return (c < -bound) | (c > bound)


def within(c, bound: float) -> Column:
    """``c BETWEEN -bound AND bound``."""
    return as_col(c).between(-bound, bound)


def inverted(lat, lon) -> Column:
    """True when the pair looks swapped.

    Either the latitude is out of its range while the longitude would be a valid
    latitude, or the longitude is out of its range while the latitude would be a
    valid longitude.
    """
    lat, lon = as_col(lat), as_col(lon)
    lat_is_lon = outside(lat, LAT_BOUND) & within(lon, LAT_BOUND)
    lon_is_lat = outside(lon, LON_BOUND) & within(lat, LON_BOUND)
    return lat_is_lon | lon_is_lat


def in_range_or_null(c, bound: float) -> Column:
    """Keep ``c`` when it lies in ``[-bound, bound]``, else NULL (type preserved)."""
    c = as_col(c)
    return F.when(within(c, bound), c)


def swapped_lat(lat, lon) -> Column:
    return F.when(inverted(lat, lon), as_col(lon)).otherwise(as_col(lat))


def swapped_lon(lat, lon) -> Column:
    return F.when(inverted(lat, lon), as_col(lat)).otherwise(as_col(lon))


def repaired_lat(lat, lon) -> Column:
    """Latitude after swap and range check."""
    return in_range_or_null(swapped_lat(lat, lon), LAT_BOUND)


def repaired_lon(lat, lon) -> Column:
    """Longitude after swap and range check."""
    return in_range_or_null(swapped_lon(lat, lon), LON_BOUND)
