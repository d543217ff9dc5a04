"""Lengths of clips that are probed once: a cache that knows by a digest of the set of clips whether it holds.

The digest (number, sum and second sum of the clips' hashes) doesn't depend on their order and adds up, so one aggregate over the clips tells without a join that the
cache has just these (a hit), or that it had just these some appends ago (it has more now: a superset). Otherwise the clips that the
cache lacks are found by an anti-join; if the digests of the cache and of these add up to that of the clips, nothing is gone and they are
appended, else the cache is rebuilt, in which known lengths stay. Only unknown clips are ever probed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.records import put_text
from ..sinks.scratch import materialise
from ..sinks.versions import _fs

Digest = tuple[int, int, int]
HIT, SUPERSET, APPEND, REBUILD = "hit", "superset", "append", "rebuild"


def digest(clips: DataFrame, key: str = "filepath") -> Digest:
    """Of the set of keys; each must come once. Sums wrap as decimals of 38 digits would not before 10**18 clips."""
    h = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), F.col(key)).cast("decimal(20,0)")), F.lit(0).cast("decimal(38,0)"))
    n, a, b = clips.agg(F.count("*"), h(1), h(2)).first()
    return int(n), int(a), int(b)


def _plus(a: Digest, b: Digest) -> Digest:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def _record(spark: SparkSession, root: str) -> list[dict]:
    """The cache's generations, oldest first: the folder of each and the digest of all up to it."""
    fs, path = _fs(spark, root)
    if not fs.exists(path(f"{root}/generations.json")):
        return []
    return json.loads(spark.read.text(f"{root}/generations.json", wholetext=True).first()[0])


def _read(spark: SparkSession, root: str, generations: list[dict]) -> DataFrame:
    return spark.read.parquet(*[f"{root}/{g['folder']}" for g in generations])


def lengths(clips: DataFrame, root: str, probe: Callable[[DataFrame], DataFrame], key: str = "filepath") -> tuple[DataFrame, str]:
    """(key, duration) of the clips, and which of the four cases it was. probe: (key) to (key, duration). Clips without a key are left out, repeated ones count once
    where the cache is asked for more than it has."""
    spark = clips.sparkSession
    own = clips.select(key).where(F.col(key).isNotNull())
    wanted, have = digest(own, key), _record(spark, root)
    for k in range(len(have), 0, -1):
        if tuple(have[k - 1]["digest"]) == wanted:
            return _read(spark, root, have[:k]).select(key, "duration"), HIT if k == len(have) else SUPERSET

    def write(rows: DataFrame, before: list[dict], total: Digest) -> list[dict]:
        folder = uuid.uuid4().hex
        rows.select(key, F.col("duration").cast("double").alias("duration")).write.parquet(f"{root}/{folder}")
        now = [*before, {"folder": folder, "digest": list(total)}]
        put_text(f"{root}/generations.json", json.dumps(now))
        return now

    own = own.distinct()
    if have:
        known = _read(spark, root, have)
        new = materialise(own.join(known.select(F.col(key).alias("__known")), own[key] == F.col("__known"), "left_anti"))
        if wanted == _plus(tuple(have[-1]["digest"]), digest(new, key)):
            return _read(spark, root, write(probe(new), have, wanted)).select(key, "duration"), APPEND
        kept = known.join(own.select(F.col(key).alias("__own")), known[key] == F.col("__own"), "left_semi")
        rows = kept.select(key, "duration").unionByName(probe(new).select(key, "duration"))
    else:
        rows = probe(own)
    return _read(spark, root, write(rows, [], digest(own, key))).select(key, "duration"), REBUILD
