"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Environment name -> Spark master.
MASTERS = {"DEV": "local[*]", "PROD": "yarn"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def spark_session(env: str, app_name: str, **extra: str) -> SparkSession:
    """Session for a named environment; unknown names are an error."""
    if env not in MASTERS:
        raise ValueError(f"unknown environment {env!r}, expected one of {sorted(MASTERS)}")
    builder = SparkSession.builder.master(MASTERS[env]).appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
