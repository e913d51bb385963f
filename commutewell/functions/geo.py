"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Office position in degrees and Earth radius in kilometres.
OFFICE_LATITUDE = 43.5673
OFFICE_LONGITUDE = 3.8965
EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in kilometres between two points in degrees; NULL when a coordinate is NULL."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_to_office_km(lat: Column, lon: Column) -> Column:
    """Distance from a point to the office."""
    return haversine_km(lat, lon, F.lit(OFFICE_LATITUDE), F.lit(OFFICE_LONGITUDE))
