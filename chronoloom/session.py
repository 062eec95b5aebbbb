"""A session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "chronoloom", **settings: str) -> SparkSession:
    """The running session, or a new one; ``settings`` are Spark's own names with underscores for periods."""
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
