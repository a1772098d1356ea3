"""Great-circle distance."""

from pyspark.sql import functions as F


def distance_km(lat1, lon1, lat2, lon2, radius_km=6371.0):
    """Haversine distance.

    The ``least(1, h)`` guard keeps antipodal rounding out of ``asin``; equal
    points give exactly zero, so no NaN can slip past a threshold.
    """
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    h = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    )
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
