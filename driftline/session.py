"""Spark session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "driftline", **settings: str) -> SparkSession:
    """UTC clock, adaptive plans, Arrow transfer. Keyword settings (dots as double underscores) override."""
    builder = SparkSession.builder.appName(name)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
