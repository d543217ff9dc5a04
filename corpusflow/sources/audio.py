"""Audio and sidecar files as tables."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths

#: Bytes of texts that a task gives at once, about.
TEXT_BYTES = 8 << 20

Decoder = Callable[[bytes], tuple[np.ndarray, int]]


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(channels, samples) between -1 and 1, and the rate, of PCM WAV."""
    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return x.reshape(-1, channels).T, rate


#: Decoders by extension; others can be added where their libraries are.
DECODERS: dict[str, Decoder] = {"wav": decode_wav}


def listing(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """(path, length, modificationTime[, content]) of audio files below root, extensions in any case."""
    ext = ",".join([e for x in paths.AUDIO_EXTENSIONS for e in (x, x.upper())])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{ext}}}").load(root)
    cols = [F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime"]
    return files.select(*cols, *(["content"] if content else []))


def _of(path: str):
    """pyarrow's file system of a path, the path in it, and what stands before that."""
    from pyarrow import fs

    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    store, where = fs.FileSystem.from_uri(uri)
    return store, where.rstrip("/"), "" if uri.startswith("file:") else uri[: uri.index(where)] if where in uri else ""


def text_files(spark: SparkSession, root: str, postfix: str) -> DataFrame:
    """(path, text) of text files below root whose name ends so; hidden ones (._) are left out, empty ones are not.

    Tasks list the folders and read the files, so neither all names nor a task for a few files each pass through the driver.
    """
    from pyarrow import fs

    store, where, _ = _of(root)
    folders = [(f.path, True) for f in store.get_file_info(fs.FileSelector(where)) if f.type == fs.FileType.Directory and not f.base_name.startswith((".", "_"))]
    tasks = 4 * spark.sparkContext.defaultParallelism
    asked = spark.createDataFrame([(where, False), *folders], "folder string, deep boolean").repartition(min(tasks, len(folders) + 1))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _of(root)[0]
        for batch in batches:
            open_ = list(zip(*(c.to_pylist() for c in batch.columns)))
            while open_:
                folder, deep = open_.pop()
                infos = [f for f in store.get_file_info(fs.FileSelector(folder)) if not f.base_name.startswith((".", "_"))]
                open_ += [(f.path, True) for f in infos if deep and f.type == fs.FileType.Directory]
                names = [f.path for f in infos if f.type == fs.FileType.File and fnmatchcase(f.base_name, f"*{postfix}")]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["path"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _, prefix = _of(root)
        for batch in batches:
            paths_, texts, size = [], [], 0
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path) as f:
                    texts.append(f.read())
                paths_.append(prefix + path)
                size += len(texts[-1])
                if size > TEXT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths_, pa.string()), pa.array(texts, pa.binary())], ["path", "text"])
                    paths_, texts, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(paths_, pa.string()), pa.array(texts, pa.binary())], ["path", "text"])

    files = asked.mapInArrow(found, "path string").repartition(tasks)
    return files.mapInArrow(read, "path string, text binary").select("path", F.col("text").cast("string").alias("text"))


def sidecars(spark: SparkSession, root: str, kinds: list[str]) -> DataFrame:
    """(stem_path, kind, text): text files named <stem>_<kind>.txt, stripped."""
    pattern = f"^(.*)_({'|'.join(sorted(kinds, key=len, reverse=True))})\\.(txt|tst)$"
    files = text_files(spark, root, ".t[xs]t").where(F.col("path").rlike(pattern))
    return files.select(F.regexp_extract("path", pattern, 1).alias("stem_path"), F.regexp_extract("path", pattern, 2).alias("kind"), F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"))


def with_sidecar(clips: DataFrame, side: DataFrame, kind: str) -> DataFrame:
    """clips with the text of one kind, empty where there is none; clips: filepath."""
    own = side.where(F.col("kind") == kind).select(F.col("stem_path").alias("__s"), F.col("text").alias(kind))
    return clips.join(own, F.regexp_replace("filepath", r"\.[^./]*$", "") == F.col("__s"), "left").drop("__s").withColumn(kind, F.coalesce(kind, F.lit("")))


def decoded(files: DataFrame, work: Callable[[np.ndarray, int], tuple], schema: str, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """(path, error, ...): work(channels, rate) of every file's signal, each decoded once.

    Files are opaque to the JVM, so this is Python over Arrow batches; an unreadable file gives its error as data. Only
    what work returns leaves the task: numbers, not samples.
    """
    known = decoders or DECODERS
    fields = [x.strip().split(" ", 1) for x in schema.split(",")]
    kinds = {"double": pa.float64(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64()), "binary": pa.binary()}
    names, types = [f[0] for f in fields], [kinds[f[1].strip()] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error, out = None, (None,) * len(names)
                try:
                    out = work(*known[path.rsplit(".", 1)[-1].lower()](data))
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([error], pa.string()), *[pa.array([v], t) for v, t in zip(out, types)]], ["path", "error", *names])

    return files.select("path", "content").mapInArrow(run, f"path string, error string, {schema}")


#: Bytes of a file's beginning in which its header is looked for.
HEADER = 1 << 16


def wav_seconds(head: bytes, size: int) -> float:
    """Seconds of a WAV file of `size` bytes from its beginning."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("no WAV header")
    at, rate = 12, 0
    while at + 8 <= len(head):
        name, n = head[at : at + 4], int.from_bytes(head[at + 4 : at + 8], "little")
        if name == b"fmt ":
            rate = int.from_bytes(head[at + 16 : at + 20], "little")  # bytes a second
        if name == b"data":
            return min(n, size - at - 8) / rate if rate else 0.0
        at += 8 + n + n % 2
    raise ValueError("no data in the header")


def probe_durations(files: DataFrame) -> DataFrame:
    """(path, error, duration) of files (path): seconds from the header; 0 where it can't be read.

    Tasks open each file and read its first bytes; a format without a header reader is decoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                error, seconds = None, 0.0
                try:
                    store, where = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                    ext = path.rsplit(".", 1)[-1].lower()
                    with store.open_input_file(where) as f:
                        if ext == "wav":
                            seconds = wav_seconds(f.read(HEADER), f.size())
                        else:
                            x, rate = DECODERS[ext](f.read())
                            seconds = x.shape[1] / rate if rate else 0.0
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                rows.append((path, error, float(seconds)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.float64()))] if rows else [pa.array([], t) for t in (pa.string(), pa.string(), pa.float64())], ["path", "error", "duration"])

    return files.select("path").mapInArrow(run, "path string, error string, duration double")


def discover(spark: SparkSession, root: str, manifest: DataFrame | None = None, source: str | None = "auto") -> DataFrame:
    """(filepath) of a corpus: from its manifest, from its files, or from the files where the manifest has none."""
    # Other names of the two sources.
    alias = {"csv": "csv", "filesystem": "rglob", "fs": "rglob", "file_system": "rglob", "rglob": "rglob"}
    how = "rglob" if source is None else alias.get(source.strip().lower().replace("-", "_"), "auto")
    if how != "rglob" and manifest is not None:
        own = manifest.select("filepath").where(F.col("filepath").isNotNull() & paths.is_audio(F.col("filepath"))).dropDuplicates()
        if how == "csv" or not own.isEmpty():
            return own
    return listing(spark, root).select(F.col("path").alias("filepath"))


def ensure_durations(clips: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(filepath, total_duration) of clips: the manifest's where they are above 0, else probed."""
    cached = manifest.where("total_duration > 0").select("filepath", "total_duration").dropDuplicates(["filepath"])
    have = clips.select("filepath").join(cached, "filepath")
    miss = clips.select("filepath").join(cached, "filepath", "left_anti")
    probed = probe_durations(files.join(miss, F.col("path") == F.col("filepath"), "left_semi"))
    return have.union(probed.select(F.col("path").alias("filepath"), F.bround("duration", 4).alias("total_duration")))


def benchmark_sample(files: DataFrame, side: DataFrame, required: list[str], least: float, n: int, seed: int | None = None) -> DataFrame:
    """n clips (path, duration) longer than `least` with all required sidecars non-empty: the first by path, or by seeded hash."""
    own = files.where(F.col("duration") > least)
    stem = F.regexp_replace("path", r"\.[^./]*$", "")
    for kind in required:
        have = side.where((F.col("kind") == kind) & (F.length("text") > 0)).select(F.col("stem_path").alias("__s")).distinct()
        own = own.join(have, stem == F.col("__s"), "left_semi")
    return own.orderBy("path" if seed is None else F.xxhash64("path", F.lit(seed)), "path").limit(n)
