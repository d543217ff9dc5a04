"""Model scorers as plug-ins: loaded once a Python worker, called on Arrow batches, errors as data."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .manifest import pending


class Scorer(Protocol):
    """A model: load() once a worker, score(items) a list of results in the items' order."""

    schema: str

    def load(self) -> None: ...

    def score(self, items: list[Any]) -> list[tuple]: ...


class HashScorer:
    """A stand-in without weights: numbers in [0, 1) that depend on the item alone."""

    def __init__(self, columns: Sequence[str], salt: str = ""):
        self.columns, self.salt = list(columns), salt
        self.schema = ", ".join(f"{c} double" for c in columns)

    def load(self) -> None:
        pass

    def score(self, items: list[Any]) -> list[tuple]:
        out = []
        for x in items:
            raw = x if isinstance(x, bytes) else str(x).encode()
            out.append(tuple(int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=f"{self.salt}{c}".encode()[:64]).digest(), "little") / 2**64 for c in self.columns))
        return out


class FunctionScorer:
    """A scorer from two functions: make() gives the model, call(model, items) the results."""

    def __init__(self, schema: str, make: Callable[[], Any], call: Callable[[Any, list[Any]], list[tuple]]):
        self.schema, self.make, self.call, self.model = schema, make, call, None

    def load(self) -> None:
        self.model = self.make()

    def score(self, items: list[Any]) -> list[tuple]:
        return self.call(self.model, items)


def device(kind: str = "gpu") -> str | None:
    """The address of the task's own device, for a scorer's load(); None where tasks have none."""
    task = TaskContext.get()
    own = task.resources().get(kind) if task else None
    return own.addresses[0] if own and own.addresses else None


def one_device(kind: str = "gpu", share: float = 1.0, cpus: int = 1) -> ResourceProfile:
    """A profile for tasks that have a device each (or a share of one); executors are as the cluster sets them up."""
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus).resource(kind, share)).build


def scored(df: DataFrame, scorer: Scorer, key: str, item: str, batch: int = 64, profile: ResourceProfile | None = None) -> DataFrame:
    """(key, error, scores...): a batch that fails is halved until it works, an item that fails gives its error.

    profile: what the scoring tasks need, such as one_device(); Spark then runs as many of them at a time as there are devices, and the stages before
    and after as before.
    """
    kind = dict(df.dtypes)[key]
    fields = T.StructType.fromDDL(scorer.schema).fields
    schema = f"{key} {kind}, error string, {scorer.schema}"
    arrow = {"binary": pa.binary(), "double": pa.float64(), "float": pa.float32(), "integer": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [arrow[f.dataType.typeName()] for f in fields]

    def attempt(items: list) -> list[tuple]:
        try:
            return [(None, *r) for r in scorer.score(items)]
        except Exception as e:  # noqa: BLE001
            if len(items) == 1:
                return [(f"{type(e).__name__}: {e}", *[None] * len(types))]
        return attempt(items[: len(items) // 2]) + attempt(items[len(items) // 2 :])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer.load()
        for b in batches:
            keys, items = b.column(0), b.column(1).to_pylist()
            rows: list[tuple] = []
            for i in range(0, len(items), batch):
                rows += attempt(items[i : i + batch])
            cols = list(zip(*rows)) if rows else [()] * (1 + len(types))
            yield pa.RecordBatch.from_arrays([keys, pa.array(cols[0], pa.string()), *[pa.array(c, t) for c, t in zip(cols[1:], types)]], [key, "error", *[f.name for f in fields]])

    return df.select(key, item).mapInArrow(run, schema, profile=profile)


def score_pending(work: DataFrame, manifest: DataFrame, scorer: Scorer, columns: Sequence[str], key: str = "filepath", item: str = "content", limit: int | None = None) -> DataFrame:
    """The scores of what the manifest has none for yet."""
    own = pending(work, manifest, columns, key)
    return scored(own.orderBy(key).limit(limit) if limit is not None else own, scorer, key, item)


def diarised(df: DataFrame, scorer: Scorer, source: str, item: str) -> DataFrame:
    """(source, pos, seg_start, seg_end, speaker) of a scorer that gives "start end speaker_k" texts, one a line."""
    from .intervals import parse_segments

    texts = scored(df, scorer, source, item).select(source, F.split("segments", "\n").alias("raw"))
    return parse_segments(texts, source, "raw")
