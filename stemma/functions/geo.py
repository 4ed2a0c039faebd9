"""Distances and boxes on the sphere as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: mean radius of the earth in metres.
RADIUS_M = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points in degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def in_box(lat: Column, lon: Column, corner: tuple[float, float], other: tuple[float, float]) -> Column:
    """Inside the box of two corners given in any order."""
    (a, b), (c, d) = corner, other
    return lat.between(min(a, c), max(a, c)) & lon.between(min(b, d), max(b, d))


def within(lat: Column, lon: Column, at: tuple[float, float], metres: float) -> Column:
    """Within the distance; a box that holds the circle is tested first, so that scans can prune."""
    dlat = metres / 111_000.0
    box = lat.between(at[0] - dlat, at[0] + dlat)
    return box & (haversine(lat, lon, F.lit(at[0]), F.lit(at[1])) <= metres)


def box_size(south: Column, west: Column, north: Column, east: Column) -> Column:
    """Struct ``width_m, height_m, area_km2`` of a box, rounded."""
    middle = (south + north) / 2
    w, h = haversine(middle, west, middle, east), haversine(south, west, north, west)
    return F.struct(F.round(w, 1).alias("width_m"), F.round(h, 1).alias("height_m"), F.round(w * h / 1e6, 3).alias("area_km2"))
