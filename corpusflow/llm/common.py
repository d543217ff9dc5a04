"""What the training-data operators share: tables, byte blocks, word hashes and connected components."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20


#: Rows and bytes of an Arrow batch: texts may be long, and a batch is held by the JVM and by Python.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- memory of Python workers ----------------------------------------------------------------


def give_back() -> None:
    """Return what this worker has freed to the system: Spark uses it again for other stages, and the executor's memory is shared."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Caches that a worker keeps from task to task, by the operator that they serve.
_caches: dict[str, dict] = {}


def keep_cache(owner: str, cache: dict) -> None:
    _caches[owner] = cache


def drop_caches(owner: str | None = None) -> None:
    """Empty the caches that other operators have left in this worker."""
    for name, cache in _caches.items():
        if name != owner:
            cache.clear()


def lean(run: Callable, owner: str | None = None) -> Callable:
    """A task's function over an iterator, in a worker that other operators' caches don't burden and that gives freed memory back when the task ends."""

    @functools.wraps(run)
    def bounded(batches):
        drop_caches(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return bounded


# --- tables in the shared folder -------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a local one only in local mode with none named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file:///tmp/corpusflow-shared"


#: Tables that materialise() has written and nothing has discarded, in order.
_written: list[str] = []


def materialise(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by materialise() that no later plan reads."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written() -> int:
    """A mark for discard_since()."""
    return len(_written)


def discard_since(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Delete all tables written since a mark but the one that `keep` reads, which must be a written table itself."""
    own = {p.rsplit("/", 1)[0].rsplit("/", 1)[-1] for p in keep.inputFiles()}
    for name in _written[mark:]:
        if name.rsplit("/", 1)[-1] not in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _written[mark:] = [n for n in _written[mark:] if n.rsplit("/", 1)[-1] in own]


# --- byte blocks -----------------------------------------------------------------------------


@dataclass
class Block:
    """Whole documents side by side: document k is buf[starts[k]:ends[k]], one separator between."""

    ids: list
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def raw(self, k: int) -> bytes:
        return self.buf[self.starts[k] : self.ends[k]].tobytes()


def blocks(
    batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES, key: str = "doc_id", text: str = "text", sep: bytes = b"\n"
) -> Iterator[Block]:
    """Blocks of at most limit bytes (a longer document is one block) from Arrow batches; null text is empty."""
    for batch in batches:
        ids = batch.column(key).to_pylist()
        col = batch.column(text).cast(pa.large_binary()).fill_null(b"")
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        data = memoryview(col.buffers()[2]) if col.buffers()[2] is not None else memoryview(b"")
        i = 0
        while i < len(ids):
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
            j = min(j, len(ids))
            buf = np.frombuffer(sep.join([data[a:b] for a, b in zip(offs[i:j], offs[i + 1 : j + 1])]), np.uint8)
            lens = offs[i + 1 : j + 1] - offs[i:j]
            starts = offs[i:j] - offs[i] + np.arange(j - i) * len(sep)
            yield Block(ids[i:j], buf, starts, starts + lens)
            i = j


# --- word hashes -----------------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(20240607))
_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER_VALUES = _VALUES[LOWER]
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _table_of_powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Bytes that span_hashes() takes at once.
PIECE = 1 << 20


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of buf[start:end], by prefix sums of a polynomial over random byte values; starts in order."""
    values = _LOWER_VALUES if lower else _VALUES
    h, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(starts, lo + PIECE))
        j = max(j, i + 1)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        n = int(e.max())
        pre = np.zeros(n + 1, np.uint64)
        np.cumsum(values[buf[lo : lo + n]] * _table_of_powers(_BASE, n), out=pre[1:])
        h[i:j] = (pre[e] - pre[s]) * _table_of_powers(_BASE_INV, n + 1)[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        i = j
    return mix(h)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """A table that is True for bytes outside the given closed ranges."""
    t = np.ones(256, bool)
    for a, b in outside:
        t[a : b + 1] = False
    return t


#: Words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z), as tables over bytes.
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def words(block: Block, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a block's words and the number of words before each document (and after the last)."""
    s, e = runs(kind[LOWER[block.buf]])
    return s, e, np.append(np.searchsorted(s, block.starts), len(s))


# --- connected components --------------------------------------------------------------------


class Forest:
    """Union-find over 0..n-1 that records the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b long), component being the smallest node reachable.

    Large-star and small-star steps (Kiveris et al., 2014) as joins and partial minimums: no node's neighbours are collected. The
    joins' other side has one row a node, so the rows of a node with very many neighbours may be split over tasks (adaptive execution
    does). Each round is a written table.
    """
    spark = edges.sparkSession
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        new = materialise(small.select("x.u", "x.v").where("u <> v").distinct())
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        discard(large)
        e = new
        if tuple(now) == before:
            break
        before = tuple(now)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
