"""The Spark session that the pipelines expect: UTC, ANSI casts, adaptive plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",  # wall-clock times are stored as if they were UTC
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def make_session(name: str = "wattledger", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` are more of them, with dots written as double underscores."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()
