"""Substring dedup by content-defined chunking.

A gear rolling hash over the last 32 bytes cuts each document where its low bits are zero, so that cuts move with
the content and an insertion changes the chunks around it only. A chunk whose digest occurs earlier (in a
document with a smaller doc_id, or before it in the same document) is removed; the first occurrence stays.

Repeats inside a window of one task are settled there, so a digest reaches the shuffle once a window and no key
is hot, however often it occurs. Digests are 128 bits of BLAKE2b.

Defined results: null or empty text has no chunks; rows whose doc_id is null are left out; rows that share a doc_id
and a text are one document and do not remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Block, blocks, give_back, lean, table
from .spans import remove

GEAR_SEED = 7
#: The average chunk is about MIN + 2**BITS bytes; MIN is no less than the 32 bytes that the hash sees, so nothing before a document matters.
BITS, MIN, MAX = 5, 32, 512
#: Text of one task in which repeats are settled at once.
WINDOW_BYTES = 16 << 20

_GEAR = np.random.Generator(np.random.PCG64(GEAR_SEED)).integers(0, 2**32, 256, dtype=np.uint32)


def gear(buf: np.ndarray) -> np.ndarray:
    """h[i] = (h[i-1] << 1) + G[buf[i]] in 32 bits, by doubling: after five steps it holds 32 bytes."""
    h = _GEAR[buf]
    for k in range(5):
        step = 1 << k
        new = h.copy()
        new[step:] += h[:-step] << np.uint32(step)
        h = new
    return h


def cuts(block: Block, bits: int = BITS, least: int = MIN, most: int = MAX) -> Iterator[np.ndarray]:
    """The ends of each document's chunks, from its start."""
    # the mask is over the high bits, which depend on all 32 bytes
    candidates = np.flatnonzero(gear(block.buf) >> np.uint32(32 - bits) == 0) + 1
    at = np.searchsorted(candidates, np.stack((block.starts, block.ends)), side="right")
    for k in range(len(block.ids)):
        start, end = int(block.starts[k]), int(block.ends[k])
        out, last = [], start
        for c in candidates[at[0, k] : at[1, k]].tolist():
            while c - last > most:
                last += most
                out.append(last - start)
            if c - last >= least:
                out.append(c - start)
                last = c
        while end - last > most:
            last += most
            out.append(last - start)
        if end > last:
            out.append(end - start)
        yield np.array(out, np.int32)


def chunks(docs: DataFrame, bits: int = BITS, least: int = MIN, most: int = MAX) -> DataFrame:
    """(doc_id, s, e, hi, lo, settled): settled chunks repeat an earlier one of their task's window and have a key of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window: list[tuple[Block, list[np.ndarray]]] = []
        size = 0
        for block in blocks(batches):
            window.append((block, list(cuts(block, bits, least, most))))
            size += len(block.buf)
            if size >= WINDOW_BYTES:
                yield from _settle(window)
                window, size = [], 0
                give_back()
        yield from _settle(window)

    own = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    return own.mapInArrow(lean(run), "doc_id long, s int, e int, hi long, lo long, settled boolean")


def _settle(window: list) -> Iterator[pa.RecordBatch]:
    for rows in _firsts(window):
        yield pa.RecordBatch.from_arrays([pa.array(rows[k]) for k in ("doc_id", "s", "e", "hi", "lo", "settled")], ["doc_id", "s", "e", "hi", "lo", "settled"])


def _firsts(window: list) -> Iterator[dict[str, np.ndarray]]:
    each = [own for _, ends in window for own in ends]
    n = [len(own) for own in each]
    if not sum(n):
        return
    end = np.concatenate(each)
    start = np.concatenate(([0], end[:-1])).astype(np.int32)
    start[np.cumsum([0, *n])[:-1][np.array(n) > 0]] = 0
    d = np.repeat(np.array([i for block, _ in window for i in block.ids], np.int64), n)
    digest, at = bytearray(16 * len(end)), 0
    for block, ends in window:
        view = memoryview(block.buf)
        for base, own in zip(block.starts.tolist(), ends):
            last = base
            for x in (own + base).tolist():
                digest[at : at + 16] = hashlib.blake2b(view[last:x], digest_size=16).digest()
                at, last = at + 16, x
    hi, lo = np.frombuffer(digest, np.int64).reshape(-1, 2).T
    order = np.lexsort((start, d, lo, hi))
    h, l, dd, ss = hi[order], lo[order], d[order], start[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (l[1:] != l[:-1])))
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    settled = (dd != dd[first]) | (ss != ss[first])
    out_hi, out_lo = h.copy(), l.copy()
    own = np.flatnonzero(settled)  # a key of their own: where they are
    out_hi[own], out_lo[own] = dd[own], ss[own].astype(np.int64) - (1 << 40)
    for i in range(0, len(order), 100_000):
        j = slice(i, i + 100_000)
        yield {"doc_id": dd[j], "s": ss[j], "e": end[order][j], "hi": out_hi[j], "lo": out_lo[j], "settled": settled[j]}


def repeats(docs: DataFrame, bits: int = BITS, least: int = MIN, most: int = MAX) -> DataFrame:
    """(doc_id, spans): the chunks of each document that occur earlier."""
    order = Window.partitionBy("hi", "lo").orderBy("doc_id", "s")
    ranked = chunks(docs, bits, least, most).withColumn("r", F.rank().over(order))
    return ranked.where("settled or r > 1").groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def deduplicate(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    return remove(docs, repeats(docs, **parameters), with_text=True)


def op7_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return remove(docs, repeats(docs))
