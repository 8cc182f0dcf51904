"""Spark sessions with the settings that the engine's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "folioforge", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster, memory and partitions are left to the caller's settings.

    Shuffle partitions start high and adaptive execution coalesces them, so one setting serves small and large inputs.
    """
    builder = SparkSession.builder.appName(name)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
