"""Derived columns of device events, the same for a batch and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    EVENT_CODE, EVENT_CODE_DEFAULT, STATUS_CATEGORY, STATUS_DEFAULT, geo_region, grid_key, mapped, priority_level,
)

EVENT_SCHEMA = "status string, event_type string, location struct<latitude: double, longitude: double>"


def enriched(events: DataFrame) -> DataFrame:
    """Category, code, region, grid key and priority; ``location`` gains region and key too."""
    latitude, longitude = F.col("location.latitude"), F.col("location.longitude")
    place = F.struct(
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        geo_region(latitude, longitude).alias("region"),
        grid_key(latitude, longitude).alias("geohash"),
    )
    return (
        events.withColumns(
            {
                "status_transformed": mapped("status", STATUS_CATEGORY, STATUS_DEFAULT),
                "event_type_transformed": mapped("event_type", EVENT_CODE, EVENT_CODE_DEFAULT),
                "location_transformed": place,
            }
        )
        .withColumn("location", F.col("location_transformed"))
        .withColumn(
            "priority_level", priority_level(F.col("status_transformed"), F.col("event_type_transformed"))
        )
    )
