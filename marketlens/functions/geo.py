"""Geographic helpers: zip-prefix centroids and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Mean latitude / longitude per zip prefix."""
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        (F.sum(lat).cast("double") / F.count(lat)).alias("latitude"),
        (F.sum(lng).cast("double") / F.count(lng)).alias("longitude"),
    )


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine distance in km, rounded to whole km; NULL if any coordinate is NULL."""
    dlat = F.radians(lat2 - lat1) / 2
    dlng = F.radians(lng2 - lng1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng), 2)
    return F.round(F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a)))
