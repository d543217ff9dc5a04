"""Files out of tables: tar shards, WAV files, deletions."""

from __future__ import annotations

import io
import json
import math
import tarfile
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import materialise

SHARD_BYTES, SHARD_SAMPLES = 512 << 20, 10_000


def clean(value):
    """JSON without NaN and infinities; what JSON lacks is text."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, dict):
        return {str(k): clean(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [clean(v) for v in value]
    return value if value is None or isinstance(value, str | int | bool) else str(value)


def tar_shards(samples: DataFrame, most_bytes: int = SHARD_BYTES, most_samples: int = SHARD_SAMPLES) -> DataFrame:
    """(name, samples, data): tar archives of samples (key, ext, content, meta map<string,string>), rolled at the limits.

    Each task writes its own shards from its own rows, so archives are as parallel as the input; no row is held twice.
    """
    names = ["name", "samples", "data"]

    def add(tar: tarfile.TarFile, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        buf, n, shard, tar = io.BytesIO(), 0, 0, None

        def close() -> pa.RecordBatch:
            tar.close()
            return pa.RecordBatch.from_arrays([pa.array([f"shard-{part:05d}-{shard:05d}.tar"]), pa.array([n], pa.int64()), pa.array([buf.getvalue()], pa.binary())], names)

        for batch in batches:
            for row in batch.to_pylist():
                if tar is not None and (n >= most_samples or buf.tell() + len(row["content"] or b"") > most_bytes):
                    yield close()
                    buf, n, shard, tar = io.BytesIO(), 0, shard + 1, None
                if tar is None:
                    tar = tarfile.open(fileobj=buf, mode="w")  # noqa: SIM115
                key = row["key"].replace(".", "_")
                add(tar, f"{key}.{row['ext']}", row["content"] or b"")
                add(tar, f"{key}.json", json.dumps(clean(dict(row["meta"] or {})), ensure_ascii=False, allow_nan=False).encode())
                n += 1
        if tar is not None:
            yield close()

    return samples.select("key", "ext", "content", "meta").mapInArrow(run, "name string, samples long, data binary")


def read_tars(spark: SparkSession, path: str) -> DataFrame:
    """(shard, key, ext, content) of all members of tar files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                    for m in tar:
                        key, _, ext = m.name.partition(".")
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, key, ext)] + [pa.array([tar.extractfile(m).read()], pa.binary())], ["shard", "key", "ext", "content"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path)
    return files.select("path", "content").mapInArrow(run, "shard string, key string, ext string, content binary")


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit PCM of (channels, samples) between -1 and 1."""
    x = (np.clip(samples, -1, 1) * 32767).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[0])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(x.T.tobytes())
    return out.getvalue()


def write_binaries(files: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """(path, bytes) of files written below root through Hadoop's file system, one a row; the originals are never touched."""
    paths = files.select(F.concat(F.lit(root.rstrip("/") + "/"), F.col(name)).alias("path"), F.col(content).alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        made = set()
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, where = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                folder = where.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(where + ".tmp") as out:
                    out.write(data)
                store.move(where + ".tmp", where)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64())], ["path", "bytes"])

    return paths.mapInArrow(run, "path string, bytes long")


def delete_flagged(spark: SparkSession, manifest: DataFrame, confirmed: bool = False) -> int:
    """Delete the files of rows flagged `deleted`; only when confirmed. Tasks delete them; returns how many were there."""
    if not confirmed:
        raise ValueError("deleting files must be confirmed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            n = 0
            for path in batch.column(0).to_pylist():
                store, where = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                if store.get_file_info(where).type == fs.FileType.File:
                    store.delete_file(where)
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    gone = manifest.where("deleted and filepath is not null").select("filepath").distinct()
    # written before it is counted: a second evaluation would find the files gone
    return materialise(gone.mapInArrow(run, "n long")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def as_wav(_, arrays: list, rate: int = 16_000) -> list[tuple]:
    """Arrays between -1 and 1 as WAV files of one channel."""
    return [(encode_wav(np.asarray(x, np.float64)[None, :], rate),) for x in arrays]


def write_tars(samples: DataFrame, root: str, most_bytes: int = SHARD_BYTES, most_samples: int = SHARD_SAMPLES) -> DataFrame:
    """(path, samples, bytes) of tar archives of samples (key, ext, content, meta), streamed by the tasks to files below root.

    A task holds one sample at a time. An archive is renamed when it is whole, so a task that is repeated leaves no half ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        store.create_dir(where, recursive=True)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        own = f".{task.taskAttemptId() if task else 0}.tmp"  # two attempts of a task don't write the same file
        shard, open_ = 0, None

        def close() -> pa.RecordBatch:
            tar, out, name, n, size = open_
            tar.close()
            out.close()
            store.move(name + own, name)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["path", "samples", "bytes"])

        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                data = row["content"] or b""
                if open_ and (open_[3] >= most_samples or open_[4] + len(data) > most_bytes):
                    yield close()
                    open_, shard = None, shard + 1
                if not open_:
                    name = f"{where}/shard-{part:05d}-{shard:05d}.tar"
                    out = store.open_output_stream(name + own)
                    open_ = [tarfile.open(fileobj=out, mode="w|"), out, name, 0, 0]  # noqa: SIM115
                key = row["key"].replace(".", "_")
                for member, raw in ((f"{key}.{row['ext']}", data), (f"{key}.json", json.dumps(clean(dict(row["meta"] or {})), ensure_ascii=False, allow_nan=False).encode())):
                    info = tarfile.TarInfo(member)
                    info.size = len(raw)
                    open_[0].addfile(info, io.BytesIO(raw))
                    open_[4] += len(raw)
                open_[3] += 1
        if open_:
            yield close()

    return samples.select("key", "ext", "content", "meta").mapInArrow(run, "path string, samples long, bytes long")
