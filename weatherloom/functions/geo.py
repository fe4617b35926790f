"""Great-circle geometry on a sphere, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom.schema import EARTH_RADIUS_KM


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance; null when any coordinate is null.

    ``1 - a`` is clamped at zero: for antipodal points rounding can push ``a``
    just past one.
    """
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), F.lit(2)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), F.lit(2))
    )
    return F.lit(2.0 * radius_km) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def on_sphere(lat: Column, lon: Column, radius_km: float = EARTH_RADIUS_KM) -> dict[str, Column]:
    """Cartesian position of a point, in km from the centre of the sphere."""
    phi, lam = F.radians(lat), F.radians(lon)
    ring = F.cos(phi) * radius_km
    return {
        "x": ring * F.cos(lam),
        "y": ring * F.sin(lam),
        "z": F.sin(phi) * radius_km,
    }
