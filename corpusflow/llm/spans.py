"""Removing byte spans from documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, lean

REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in (start, end) spans."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif s < e:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, z): texts compressed before the shuffle, a third of what the shuffle itself makes of them."""
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        for block in blocks([batch]):
            z = [pack.compress(block.raw(k)) for k in range(len(block.ids))]
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(z, pa.binary())], ["doc_id", "z"])


def remove(docs: DataFrame, spans: DataFrame, with_text: bool = False) -> DataFrame:
    """REMOVED for each document with a doc_id: the spans (doc_id, spans array<struct<s,e>>) cut out of its UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                rows = []
                for doc_id, z, spans_ in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    text, cut = unpack.decompress(z), merged(spans_ or [])
                    kept, last = [], 0
                    for s, e in cut:
                        kept.append(text[last:s])
                        last = e
                    kept = b"".join([*kept, text[last:]])
                    rows.append((doc_id, len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in REMOVED.split(", ")])

    own = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(lean(_squeezed), "doc_id long, z binary")
    joined = own.join(spans.select("doc_id", "spans"), "doc_id", "left").select("doc_id", "z", "spans")
    out = joined.mapInArrow(lean(run), REMOVED)
    return out if with_text else out.drop("kept")
