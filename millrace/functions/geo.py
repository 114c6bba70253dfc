"""Distances and boxes on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (haversine)."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside (west, south, east, north); a box whose west exceeds its east crosses the date line."""
    west, south, east, north = box
    across = lon.between(west, east) if west <= east else ((lon >= west) | (lon <= east))
    return lat.between(south, north) & across


def box_around(lat: Column, at_lat: float, radius_km: float) -> Column:
    """The band of latitudes that holds a circle: cheap, and a scan can skip data by it."""
    reach = radius_km / 111.0 + 0.01
    return lat.between(at_lat - reach, at_lat + reach)
