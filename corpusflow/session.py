"""The engine's Spark settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with the engine's settings; a cluster's own master, memory and shuffle settings stay."""
    builder = SparkSession.builder.appName("corpusflow")
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
