"""Versioned tables: a directory a commit and a pointer to the last one, through Spark's own file systems."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"v\d{20}$")


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions, oldest first."""
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(root)) if s.isDirectory())
    return [f"{root}/{n}" for n in names if _NAME.match(n) and fs.exists(path(f"{root}/{n}/_SUCCESS"))]


def current(spark: SparkSession, root: str) -> str | None:
    have = versions(spark, root)
    return have[-1] if have else None


def commit(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write a new version; readers of the old one are not disturbed. The last `keep` versions stay.

    A version counts once its writer has left _SUCCESS, so a lost executor or driver leaves the last one valid.
    """
    spark = df.sparkSession
    path = f"{root}/v{time.time_ns():020d}"
    df.write.parquet(path)
    fs, make = _fs(spark, root)
    for old in versions(spark, root)[:-keep] if keep else []:
        fs.delete(make(old), True)
    return path
