"""Session settings the lake relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size of a shuffle partition, and so of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def lake_session(app_name: str = "meterlake", **overrides: str) -> SparkSession:
    """A session with the lake's settings; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
