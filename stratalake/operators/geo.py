"""Coordinate repair as a single projection over any DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._cols import require_columns
from ..functions import geo as G

MODES = ("atomic", "sequential")


def repair_coordinates(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    mode: str = "atomic",
) -> DataFrame:
    """Swap inverted (lat, lon) pairs, then null values outside [-90,90] / [-180,180].

    ``mode="atomic"`` (default) computes both new columns from the *input* pair in
    one projection. ``mode="sequential"`` reproduces two chained column
    replacements in which the longitude is recomputed from the already repaired
    latitude: (-120, 40) becomes (40, 40) instead of (40, -120).

    Pure projection: no shuffle, column types are preserved.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    require_columns(df, [lat, lon])
    if mode == "atomic":
        return df.withColumns(
            {lat: G.repaired_lat(lat, lon), lon: G.repaired_lon(lat, lon)}
        )
    new_lat = G.repaired_lat(lat, lon)
    # The longitude expression sees the replaced latitude column.
    return df.withColumn(lat, new_lat).withColumn(lon, G.repaired_lon(lat, lon))


def inversion_flags(df: DataFrame, lat: str = "latitude", lon: str = "longitude"):
    """Add boolean ``inverted`` (swap applies) next to the input columns."""
    require_columns(df, [lat, lon])
    return df.withColumn("inverted", G.inverted(lat, lon))


def inversion_counts(df: DataFrame, lat: str = "latitude", lon: str = "longitude"):
    """Row count per value of the swap flag (NULL flag = undecidable pair)."""
    return (
        inversion_flags(df, lat, lon)
        .groupBy("inverted")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
