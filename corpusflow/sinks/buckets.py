"""A manifest in hash buckets with a snapshot log: an upsert rewrites the buckets in which something changes, and no other file.

Below root, `data/` has a folder a commit with Parquet files a bucket, and `log/` a record a version, which names the files that its
changed buckets now have. The table at a version is the last entry of every bucket up to it; every FULL versions a record lists all buckets, so
few records are read. A record appears by a rename once all its files are there: a crash before leaves files that no version
names, which vacuum() deletes. One writer at a time; a second one that commits the same version is refused.

The driver holds a row a bucket and a name a file, as Spark itself does of any table; buckets are meant to hold some 100 MB each, resize() deals
them anew. Defined results: rows without a key are left out; of rows that share a key in a batch, the last by `order` counts; a
batch that changes nothing (the same one again, say) commits nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.manifest import keep_last, upsert
from .versions import _fs

BUCKETS = 64
#: Every so many versions a record lists all buckets.
FULL = 20
_BUCKET = "__bucket"


@dataclass
class Snapshot:
    version: int
    key: str
    buckets: int
    schema: T.StructType
    #: Files of each bucket that has any, relative to root.
    files: dict[int, list[str]]
    #: Batches that have been taken, by their source: the last id of each.
    batches: dict[str, int]


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, path = _fs(spark, root)
    if not fs.exists(path(f"{root}/log")):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(path(f"{root}/log")) if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith("."))


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """The table's state at a version, the last one by default; None without any."""
    have = [v for v in versions(spark, root) if version is None or v <= version]
    if not have or version is not None and have[-1] != version:
        return None
    first = max((v for v in have if v % FULL == 0), default=have[0])
    names = [f"{root}/log/{v:020d}.json" for v in have if v >= first]
    records = sorted((json.loads(r[0]) for r in spark.read.text(names, wholetext=True).collect()), key=lambda r: r["version"])  # at most FULL of them
    files: dict[int, list[str]] = {}
    batches: dict[str, int] = {}
    for r in records:
        if r["full"]:
            files = {}
        files.update({int(b): f for b, f in r["files"].items()})
        batches.update(r["batches"])
    last = records[-1]
    return Snapshot(last["version"], last["key"], last["buckets"], T.StructType.fromJson(last["schema"]), {b: f for b, f in files.items() if f}, batches)


def _read(spark: SparkSession, root: str, at: Snapshot, buckets: set[int] | None = None) -> DataFrame:
    names = [f"{root}/{f}" for b, own in sorted(at.files.items()) if buckets is None or b in buckets for f in own]
    return spark.read.schema(at.schema).parquet(*names) if names else spark.createDataFrame([], at.schema)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table at a version, the last one by default; columns that came later are null in older files. None without a version."""
    at = snapshot(spark, root, version)
    return None if at is None else _read(spark, root, at)


def _write(rows: DataFrame, root: str, key: str, buckets: int) -> dict[int, list[str]]:
    """Write rows a bucket; the new files of each."""
    spark = rows.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    dealt = rows.withColumn(_BUCKET, bucket_of(F.col(key), buckets)).repartition(_BUCKET).sortWithinPartitions(_BUCKET, key)
    dealt.write.partitionBy(_BUCKET).parquet(f"{root}/{folder}")
    fs, path = _fs(spark, root)
    out: dict[int, list[str]] = {}
    for s in fs.globStatus(path(f"{root}/{folder}/{_BUCKET}=*/*.parquet")) or []:
        bucket = s.getPath().getParent().getName()
        out.setdefault(int(bucket.split("=")[1]), []).append(f"{folder}/{bucket}/{s.getPath().getName()}")
    return out


def _commit(spark: SparkSession, root: str, version: int, key: str, buckets: int, schema: T.StructType, files: dict[int, list[str]], batches: dict[str, int], full: bool) -> int:
    record = {"version": version, "key": key, "buckets": buckets, "schema": schema.jsonValue(), "full": full, "files": files, "batches": batches}
    fs, path = _fs(spark, root)
    final, part = path(f"{root}/log/{version:020d}.json"), path(f"{root}/log/.{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(json.dumps(record), "utf-8"))
    out.close()
    if fs.exists(final) or not fs.rename(part, final):
        fs.delete(part, False)
        raise RuntimeError(f"version {version} was committed by another writer")
    return version


def _differs(old: DataFrame, new: DataFrame, key: str, preserve: bool) -> Column:
    """Of rows of new joined to old: whether the upsert would change something."""
    out = F.col("__old").isNull()
    for c in new.columns:
        if c in (key, _BUCKET):
            continue
        before = old[c] if c in old.columns else F.lit(None)
        changed = ~new[c].eqNullSafe(before)
        out = out | ((new[c].isNotNull() & changed) if preserve else changed)
    return out


def merge(batch: DataFrame, root: str, key: str = "filepath", order: tuple[str, ...] = (), preserve: bool = True, buckets: int = BUCKETS, source: str | None = None, batch_id: int | None = None) -> int | None:
    """Upsert a batch; the new version, None if nothing changes. `buckets` counts for a new table only.

    preserve: a null never erases. order: columns by which the last row of a key is found, which the table doesn't keep. With a source and a batch's id,
    a batch that isn't newer than the source's last one has been taken already.
    """
    spark = batch.sparkSession
    at = snapshot(spark, root)
    if at and source is not None and batch_id is not None and at.batches.get(source, -1) >= batch_id:
        return None
    new = batch.where(F.col(key).isNotNull())
    new = (keep_last(new, key, *order) if order else new.dropDuplicates([key])).drop(*[o for o in order if o != key])
    taken = {source: batch_id} if source is not None and batch_id is not None else {}
    if at is None:
        files = _write(new, root, key, buckets)
        return _commit(spark, root, 0, key, buckets, new.schema, files, taken, True)
    if at.key != key:
        raise ValueError(f"the table's key is {at.key}")
    for f in new.schema:
        if f.name in at.schema.names and at.schema[f.name].dataType != f.dataType:
            raise ValueError(f"{f.name} is {at.schema[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the batch")
    # only buckets in which something changes are written: a row a bucket reaches the driver
    new = new.withColumn(_BUCKET, bucket_of(F.col(key), at.buckets))
    asked = {r[0] for r in new.select(_BUCKET).distinct().collect()}
    old = _read(spark, root, at, asked)
    mine = old.select(key, *[c for c in new.columns if c in old.columns and c != key]).withColumnsRenamed({key: "__old"})
    changed = {r[0] for r in new.join(mine, new[key] == mine["__old"], "left").where(_differs(mine, new, key, preserve)).select(new[_BUCKET]).distinct().collect()}
    added = [f for f in new.schema if f.name not in (*at.schema.names, _BUCKET)]
    if not changed and not added:
        return None
    schema = T.StructType([*at.schema, *[T.StructField(f.name, f.dataType) for f in added]])
    own = new.where(F.col(_BUCKET).isin(sorted(changed))).drop(_BUCKET) if changed else new.limit(0).drop(_BUCKET)
    files = _write(upsert(_read(spark, root, at, changed), own, key, preserve).select(schema.names), root, key, at.buckets) if changed else {}
    version = at.version + 1
    full = version % FULL == 0
    return _commit(spark, root, version, key, at.buckets, schema, {**at.files, **files} if full else files, {**at.batches, **taken} if full else taken, full)


def resize(spark: SparkSession, root: str, buckets: int) -> int:
    """Deal the table into another number of buckets: a version whose record lists all of them."""
    at = snapshot(spark, root)
    files = _write(_read(spark, root, at), root, at.key, buckets)
    version = -(-(at.version + 1) // FULL) * FULL  # a version that readers begin at
    return _commit(spark, root, version, at.key, buckets, at.schema, files, at.batches, True)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the data that none of the last `keep` versions names, and commits that never came to a record; how many files went.

    Not while a batch is being merged. Older versions can't be read any more.
    """
    have = versions(spark, root)
    used = {f for v in have[-keep:] for own in snapshot(spark, root, v).files.values() for f in own}
    fs, path = _fs(spark, root)
    n = 0
    for s in fs.globStatus(path(f"{root}/data/*/{_BUCKET}=*/*.parquet")) or []:
        name = "/".join(s.getPath().toString().split("/")[-4:])
        if name not in used:
            fs.delete(s.getPath(), False)
            n += 1
    return n
