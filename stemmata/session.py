"""Session settings that the plans here are meant for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str = "local[*]", **settings: str) -> SparkSession:
    """A session with adaptive planning and UTC; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
