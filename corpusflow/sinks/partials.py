"""Partial tables: results are appended run by run and never rewritten, so a lost worker or driver costs its own task's rows at most.

A run is a folder of CSV files whose name has its time and a mark of its columns, so all runs with the same columns are one scan. Many runs are compacted in
levels: once there are FAN tables on a level, the last rows of their keys become one Parquet table on the next. It counts from the moment
on which its list of inputs is there; these are then passed over by readers, and deleted.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import keep_last, union_partials
from .versions import _fs

#: Tables of a level that become one on the next.
FAN = 16
_ORDER = ("__run", "__file", "__row")
_RUN = re.compile(r"p\d{20}(-[0-9a-f]{8})?$")
_LEVEL = re.compile(r"l(\d+)-\d{20}$")


def append(df: DataFrame, root: str) -> str:
    """Append df as a partial table of its own below root: CSV with a header in each file, rows in the order in which tasks give them."""
    mark = hashlib.md5(json.dumps(df.columns).encode()).hexdigest()[:8]
    path = f"{root}/p{time.time_ns():020d}-{mark}"
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _names(spark: SparkSession, root: str) -> list[str]:
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(root)) if s.isDirectory())
    return [n for n in names if fs.exists(path(f"{root}/{n}/_SUCCESS"))]


def _record(spark: SparkSession, root: str, name: str) -> dict | None:
    """What a compacted table was made of; None before it counts."""
    fs, path = _fs(spark, root)
    at = path(f"{root}/inputs/{name}.json")
    if not fs.exists(at):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(at.toString(), wholetext=True).collect()))


def _tables(spark: SparkSession, root: str) -> tuple[list[str], dict[str, dict]]:
    """Runs that are in no compacted table, and the compacted tables that count with their records."""
    names = _names(spark, root)
    levels = {n: r for n in names if _LEVEL.match(n) and (r := _record(spark, root, n)) is not None}
    gone = {i for r in levels.values() for i in r["inputs"]}
    return [n for n in names if _RUN.match(n) and n not in gone], {n: r for n, r in levels.items() if n not in gone}


def runs(spark: SparkSession, root: str) -> list[str]:
    """Partial tables whose writers have ended and that aren't compacted, oldest first."""
    return [f"{root}/{n}" for n in _tables(spark, root)[0]]


def _parts(spark: SparkSession, root: str, names: list[str], levels: list[str]) -> list[DataFrame]:
    """All rows with their places, a scan for each set of columns."""
    alike: dict[str, list[str]] = {}
    for n in names:
        alike.setdefault(n.split("-")[1] if "-" in n else n, []).append(n)
    out = []
    for own in alike.values():
        raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv([f"{root}/{n}" for n in own])
        if raw.columns:
            run = F.regexp_extract(F.col("_metadata.file_path"), r"/(p\d{20})[^/]*/[^/]*$", 1)
            # a file is read whole by one task, so its rows are numbered in order
            out.append(raw.withColumns(dict(zip(_ORDER, (run, F.col("_metadata.file_name"), F.monotonically_increasing_id())))))
    if levels:
        out.append(spark.read.option("mergeSchema", True).parquet(*[f"{root}/{n}" for n in levels]))
    return out


def _last(parts: list[DataFrame], key: str) -> DataFrame:
    return keep_last(union_partials(parts), key, *_ORDER)


def merged(spark: SparkSession, root: str, key: str = "filepath") -> DataFrame | None:
    """All partial tables, every column as text; of a key's rows the last counts: by run, by file and by place in it. None without any."""
    names, levels = _tables(spark, root)
    parts = _parts(spark, root, names, list(levels))
    return _last(parts, key).drop(*_ORDER) if parts else None


def compact(spark: SparkSession, root: str, key: str = "filepath", fan: int = FAN) -> int:
    """Compact every level that has `fan` tables or more, from the lowest up; how many tables were made. One at a time."""
    made, level = 0, 0
    while True:
        names, levels = _tables(spark, root)
        mine = names if level == 0 else [n for n in levels if int(_LEVEL.match(n)[1]) == level]
        if len(mine) >= fan:
            parts = _parts(spark, root, mine, []) if level == 0 else _parts(spark, root, [], mine)
            name = f"l{level + 1}-{time.time_ns():020d}"
            n = sum(levels[m]["rows"] for m in mine) if level else _count(parts)
            (_last(parts, key) if parts else spark.createDataFrame([], f"`{key}` string, __run string, __file string, __row long")).write.parquet(f"{root}/{name}")
            _put_record(spark, root, name, {"inputs": mine, "rows": n})
            fs, path = _fs(spark, root)
            for m in mine:
                fs.delete(path(f"{root}/{m}"), True)
            made += 1
        elif level >= max((int(_LEVEL.match(n)[1]) for n in levels), default=0):
            return made
        level += 1


def _put_record(spark: SparkSession, root: str, name: str, record: dict) -> None:
    fs, path = _fs(spark, root)
    part = path(f"{root}/inputs/.{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(json.dumps(record), "utf-8"))
    out.close()
    if not fs.rename(part, path(f"{root}/inputs/{name}.json")):
        raise OSError(f"{name} could not be recorded")


def _count(parts: list[DataFrame]) -> int:
    counts = [p.agg(F.count("*").alias("n")) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), counts).agg(F.sum("n")).first()[0] if counts else 0


def remaining(work: DataFrame, root: str, key: str = "filepath") -> DataFrame:
    """work whose key no partial table has."""
    done = merged(work.sparkSession, root, key)
    if done is None:
        return work
    done = done.select(F.col(key).cast(dict(work.dtypes)[key]).alias("__done"))
    return work.join(done, work[key] == F.col("__done"), "left_anti")


def rows(spark: SparkSession, root: str) -> int:
    """Rows that were appended, those of compacted tables by their records."""
    names, levels = _tables(spark, root)
    return _count(_parts(spark, root, names, [])) + sum(r["rows"] for r in levels.values())
