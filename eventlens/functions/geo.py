"""Distances and boxes on latitude and longitude in degrees."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_MILES = 3958.8

# The box of the ten-hour rule, open on every side.
RULE_BOX = {"lat_min": 44.57, "lat_max": 44.91, "lon_min": 20.20, "lon_max": 20.62}


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles; NULL if a coordinate is."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = (half_dlat * half_dlat
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon)
    # rounding may push h a hair over 1 for antipodes; least() would turn NULL into 1
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def inside_box(lat: Column, lon: Column, lat_min: float, lat_max: float,
               lon_min: float, lon_max: float) -> Column:
    """Strictly inside: a point on an edge is outside (``between`` would keep it)."""
    return (lat > lat_min) & (lat < lat_max) & (lon > lon_min) & (lon < lon_max)
