"""Ingest of track records: each id once, across batches and restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_records(stream: DataFrame, key: str, event_time: str | None = None, within: str | None = None) -> DataFrame:
    """The first record of each key. With an event time, keys are remembered for `within` only, so the state stays bounded."""
    if event_time and within:
        return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str = "audio_id", seconds: int | None = None, include_seen: bool = False) -> StreamingQuery:
    """Poll JSON lines of a folder and append new records to target: every `seconds`, or all there is and then stop."""
    stream = spark.readStream.schema(schema).json(source)
    own = stream if include_seen else new_records(stream.where(F.col(key).isNotNull()), key)
    out = own.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=f"{seconds} seconds") if seconds else out.trigger(availableNow=True)).start()


def sessions(stream: DataFrame, key: str, event_time: str, gap: str, late: str) -> DataFrame:
    """Session windows with a watermark: islands of events no further apart than gap."""
    w = stream.withWatermark(event_time, late).groupBy(key, F.session_window(event_time, gap))
    return w.agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
