"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees; NULL as soon as any input is NULL."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2.0)
    )
    # Rounding can push antipodal points a hair past 1, and sqrt of a negative is NaN.
    chord = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1.0 - chord))
