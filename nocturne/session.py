"""Sessions with the settings that the engine expects; a given session is never changed."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(name: str = "nocturne", **options: str) -> SparkSession:
    """An active session, or a new one with adaptive execution and UTC."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
