"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; without one, which only local mode allows, a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file:///tmp/corpusflow-shared"
    return root.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """df written once and read back: later plans read the same rows, whatever is recomputed."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/s-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
