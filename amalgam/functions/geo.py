"""Web-Mercator tiles and great-circle distance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

TILES = 1024
LIMIT = 85.05112878
EARTH_KM = 6371.0


def _clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def tile_id(lng: Column, lat: Column, tiles: int = TILES) -> Column:
    """x * tiles + y of the tile that holds a point; poles and the date line clamp to the border tiles."""
    phi = F.radians(_clamp(lat, -LIMIT, LIMIT))
    x = F.floor(_clamp((lng + 180.0) / 360.0 * tiles, 0.0, tiles - 1.0))
    y = F.floor(_clamp((1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0 * tiles, 0.0, tiles - 1.0))
    return (x * tiles + y).cast("long")


def parent_tile(tile: Column, tiles: int = TILES) -> Column:
    """The tile one zoom step up, in the same numbering."""
    return (F.floor(F.floor(tile / tiles) / 2) * tiles + F.floor((tile % tiles) / 2)).cast("long")


def is_null_island(lng: Column, lat: Column) -> Column:
    """Placeholder coordinates (0, 0) and (1, 1)."""
    return ((lng == 0) & (lat == 0)) | ((lng == 1) & (lat == 1))


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def percentiles(value: Column, at: tuple[float, ...] = (0.5, 0.95, 0.99)) -> list[Column]:
    """Exact percentiles p50, p95, p99 (or others) of errors, to compare two ways to place points."""
    return [F.percentile(value, F.lit(p)).alias(f"p{round(p * 100)}") for p in at]


@F.pandas_udf(BinaryType())
def _points(lng: pd.Series, lat: pd.Series) -> pd.Series:
    head = b"\x01" + (1).to_bytes(4, "little")
    pairs = np.column_stack([lng.to_numpy("float64"), lat.to_numpy("float64")]).astype("<f8")
    return pd.Series([head + p.tobytes() if np.isfinite(p).all() else None for p in pairs])


def point_wkb(lng: Column, lat: Column) -> Column:
    """A point as well-known binary, little-endian; null where a coordinate is."""
    return _points(lng.cast("double"), lat.cast("double"))
