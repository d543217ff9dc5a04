"""Exact substring dedup by merging Burrows-Wheeler transforms of shards.

Every 50-byte string of a text belongs to the fragment around its minimizer (the 12 bytes with the smallest hash
in it); equal strings have equal minimizers, so fragments dealt by minimizer bring all equal strings together, in
buckets that are independent of each other. In a bucket the fragments that can share a string with another document
are kept by the shard that they come from; each shard sorts its own suffixes and has its transform. The transforms
are merged by iterative interleave refinement (Holt and McMillan, 2014): the interleave starts shard by shard, and each pass
over the transforms sorts it by one more byte, without sorting suffixes again. Boundaries that a pass sets give the
common prefixes; what is undivided after 50 passes are the repeated intervals, whose smallest document keeps its bytes.

A window of a task settles its own repeats and sends each distinct fragment once, so equal fragments make no key hot. A minimizer
around which very many different fragments stand (known from a bounded sample of the texts, which decides routes and no
result) is split: each of its strings has at least HALF bytes more on the left of the minimizer or on the right, and is dealt by these too.
Fragments are compared by 128 bits of hashes, strings by their bytes.

Defined results: null or empty text has no bytes; rows whose doc_id is null are left out; rows that share a doc_id are one
document (they share their spans, and their strings don't remove each other).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Block, blocks, mix, span_hashes, table
from .spans import remove

LENGTH = 50
#: Bytes of a minimizer, 8 at least: shorter ones make longer fragments that overlap less, but some become frequent.
MINIMIZER = 12
#: Text of a task that settles its own repeats; text of a bucket; shards whose transforms are merged in a bucket.
WINDOW_BYTES, BUCKET_BYTES, SHARDS = 20 << 20, 6 << 20, 16

#: Bytes beside a minimizer that split it; text of the sample that finds minimizers to split, and how many of them there are at most.
HALF = (LENGTH - MINIMIZER) // 2
SAMPLE_BYTES, SPLIT = 32 << 20, 1_000_000
#: Buckets whose fragments are brought together at once; widths of the ranges by which fragments are pruned.
TOGETHER, ROUNDS = 16, (20, 10, 5)

SENT = "bucket int, kind int, shard int, blob binary"
SPANS = "doc_id long, s int, e int"
#: What a blob holds: documents, whether a fragment is of the next one, its number of places, steps between places, bytes, bytes before its minimizer.
PACKED = (np.int64, np.uint8, np.int32, np.int32, np.int16, np.uint8)


# --- fragments -------------------------------------------------------------------------------


def _longs(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a number: a view, one byte from each to the next."""
    return np.ndarray((max(0, len(buf) - 7),), "<u8", np.ascontiguousarray(buf), strides=(1,))


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = width - span
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def fragments(block: Block, length: int) -> dict[str, np.ndarray]:
    """Start, size, place of the minimizer, its hash and the document of each fragment of a block, in order."""
    buf, k = block.buf, MINIMIZER
    none = {x: np.zeros(0, np.int64) for x in ("at", "size", "mark", "doc")} | {"hash": np.zeros(0, np.uint64), "digest": np.zeros(0, np.uint64)}
    if len(buf) < length:
        return none
    u, m = _longs(buf).copy(), len(buf) - k + 1
    h = np.zeros(m, np.uint64)
    for j in [*range(0, k - 8, 8), k - 8]:
        h = mix(h + u[j : j + m])
    place = np.uint64((1 << 32) - 1)  # 32 bits of the hash decide, then the first place
    pos = (_least((h & ~place) | np.arange(m, dtype=np.uint64), length - k + 1) & place).astype(np.int64)
    doc = np.repeat(np.arange(len(block.ids)), np.diff(np.append(block.starts, len(buf) + 1)))[: len(pos)]
    inside = np.arange(len(pos)) + length <= block.ends[doc]
    new = np.ones(len(pos), bool)
    new[1:] = (pos[1:] != pos[:-1]) | (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pos)) - 1
    first, last = first[inside[first]], last[inside[first]]
    size = last + length - first
    return {"at": first, "size": size, "mark": pos[first] - first, "doc": doc[first], "hash": h[pos[first]], "digest": span_hashes(buf, first, first + size, lower=False)}


def _gather(buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all fragments, one after another."""
    out = np.empty(int(size.sum()), np.uint8)
    done = np.cumsum(size) - size
    for i in range(0, len(at), 20_000):
        j = slice(i, i + 20_000)
        n = size[j]
        index = np.arange(int(n.sum())) + np.repeat(at[j] - (done[j] - done[i]), n)
        out[done[i] : done[i] + len(index)] = buf[index]
    return out


def _groups(digest: np.ndarray, hash_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal fragments together, and where each group starts in it."""
    order = np.argsort(digest, kind="stable")
    d, h = digest[order], hash_[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return order, np.flatnonzero(new)


def _pack(doc: np.ndarray, count: np.ndarray, places: np.ndarray, size: np.ndarray, mark: np.ndarray, data: np.ndarray) -> bytes:
    new = np.empty(len(doc), np.int32)  # a document's fragments stand side by side
    new[0], new[1:] = 0, doc[1:] != doc[:-1]
    ids = np.concatenate((doc[:1], doc[1:][new[1:] > 0]))
    steps = places.copy()
    steps[1:] -= places[:-1]
    ids[1:] -= ids[:-1].copy()
    # numbers byte by byte and apart from the bytes of the text: both compress better so
    planes = [x.astype(t).view(np.uint8).reshape(len(x), -1).T.tobytes() for x, t in zip((ids, new, count, steps, size, mark), PACKED)]
    numbers = zstandard.compress(b"".join(planes), 3)
    return struct.pack("<qqqq", len(ids), len(doc), len(places), len(numbers)) + numbers + zstandard.compress(data.tobytes(), 3)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    n_ids, n, n_places, end = struct.unpack_from("<qqqq", blob)
    raw, at, out = zstandard.decompress(blob[32 : 32 + end]), 0, []
    for kind, size in zip(PACKED, (n_ids, n, n, n_places, n, n)):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, width * size, at).reshape(width, size).T).reshape(-1).view(kind))
        at += width * size
    ids, index, count, places, size, mark = out
    return {"doc": np.cumsum(ids)[np.cumsum(index, dtype=np.int64)], "count": count, "places": np.cumsum(places, dtype=np.int64), "size": size.astype(np.int64), "mark": mark.astype(np.int64), "data": np.frombuffer(zstandard.decompress(blob[32 + end :]), np.uint8)}


def _parts(hash_: np.ndarray, size: np.ndarray, mark: np.ndarray, split: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is dealt of some fragments: (fragment, offset, size, mark, side), side being 0 whole, 1 with HALF bytes left of the minimizer, 2 right of it."""
    at = np.searchsorted(split, hash_)
    at[at == len(split)] = 0
    hot = split[at] == hash_ if len(split) else np.zeros(len(hash_), bool)
    every = np.arange(len(hash_))
    if not hot.any():
        zero = np.zeros(len(hash_), np.int64)
        return every, zero, size, mark, zero
    whole, left = every[~hot], every[hot & (mark >= HALF)]
    skip = np.maximum(mark - (HALF - 1), 0)
    right = every[hot & (size - skip >= length)]
    zero = np.zeros(len(whole), np.int64)
    part = np.concatenate((whole, left, right))
    offset = np.concatenate((zero, np.zeros(len(left), np.int64), skip[right]))
    # the left part ends with the last string that has HALF bytes before the minimizer
    end = np.concatenate((size[whole], np.minimum(mark[left] - HALF + length, size[left]), size[right]))
    side = np.concatenate((zero, np.full(len(left), 1), np.full(len(right), 2)))
    ok = end - offset >= length
    return part[ok], offset[ok], (end - offset)[ok], (mark[part] - offset)[ok], side[ok]


def _send(buckets: int, length: int, split: np.ndarray):
    names = [x.split()[0] for x in SENT.split(", ")]

    def settle(window: list, shard: int) -> Iterator[pa.RecordBatch]:
        """Fragments that a smaller document of this window has are removed here; each other one is sent once."""
        if not window:
            return
        base = np.cumsum([0] + [len(b.buf) for b, _ in window])
        buf = np.concatenate([b.buf for b, _ in window])
        col = {k: np.concatenate([f[k] for _, f in window]) for k in ("size", "mark", "hash", "digest")}
        at = np.concatenate([f["at"] + o for (_, f), o in zip(window, base)])
        ids = np.concatenate([np.array(b.ids, np.int64) for b, _ in window])
        starts = np.concatenate([b.starts + o for (b, _), o in zip(window, base)])
        row = np.concatenate([f["doc"] + o for (_, f), o in zip(window, np.cumsum([0] + [len(b.ids) for b, _ in window]))])
        window.clear()  # all of it has been copied
        if not len(at):
            return
        doc, place = ids[row], at - starts[row]
        order, first = _groups(col["digest"], col["hash"])
        least = np.minimum.reduceat(doc[order], first)
        sizes = np.diff(np.append(first, len(order)))
        settled = np.zeros(len(at), bool)
        settled[order] = doc[order] > np.repeat(least, sizes)
        # runs of settled fragments are one span
        s = np.flatnonzero(settled)
        if len(s):
            end = place[s] + col["size"][s]
            new = np.ones(len(s), bool)
            new[1:] = (row[s][1:] != row[s][:-1]) | (place[s][1:] > end[:-1])
            cut = np.flatnonzero(new)
            spans = np.stack((doc[s][cut], place[s][cut], np.maximum.reduceat(end, cut)))
            for i in range(0, spans.shape[1], 100_000):
                blob = zstandard.compress(spans[:, i : i + 100_000].tobytes(), 3)
                yield pa.RecordBatch.from_arrays([pa.array([(shard + i) % buckets], pa.int32()), pa.array([1], pa.int32()), pa.array([shard], pa.int32()), pa.array([blob], pa.binary())], names)
        del row, starts, s
        # the others by bucket, in the order of the text
        kept = order[~settled[order]]
        group = np.repeat(np.arange(len(first)), sizes)[~settled[order]]
        head = np.ones(len(kept), bool)
        head[1:] = group[1:] != group[:-1]
        heads = np.flatnonzero(head)
        count = np.diff(np.append(heads, len(kept)))
        del order, settled, group, head, least, sizes, first
        part, offset, size, mark, side = _parts(col["hash"][kept[heads]], col["size"][kept[heads]], col["mark"][kept[heads]], split, length)
        own = kept[heads[part]]
        key = col["hash"][own] ^ np.uint64(0xB5297A4D3F84D5B5)
        for which, shift in ((1, -HALF), (2, MINIMIZER)):
            j = np.flatnonzero(side == which)
            key[j] = mix(key[j] + _hash_at(buf, at[own[j]] + col["mark"][own[j]] + shift, HALF) + np.uint64(which))
        bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((own, bucket))
        bucket = bucket[by]
        del key, side, col["digest"], col["hash"], col["size"], col["mark"]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(by))
        for i in range(0, len(cuts) - 1, TOGETHER):  # columns of many buckets at once, then a slice of them for each
            edge = cuts[i : i + TOGETHER + 1] - cuts[i]
            g = by[cuts[i] : cuts[i] + edge[-1]]
            f, h = own[g], part[g]
            n, length_, mark_, doc_ = count[h], size[g], mark[g], doc[f]
            many = np.concatenate(([0], np.cumsum(n)))
            members = kept[np.arange(many[-1]) + np.repeat(heads[h] - many[:-1], n)]
            places, data = place[members] + np.repeat(offset[g], n), _gather(buf, at[f] + offset[g], length_)
            bytes_ = np.concatenate(([0], np.cumsum(length_)))
            blobs = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                blobs.append(_pack(doc_[a:b], n[a:b], places[many[a] : many[b]], length_[a:b], mark_[a:b], data[bytes_[a] : bytes_[b]]))
            zero = np.zeros(len(blobs), np.int32)
            cols = [bucket[cuts[i] + edge[:-1]].astype(np.int32), zero, zero + np.int32(shard), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() if TaskContext.get() else 0
        window, size = [], 0
        for block in blocks(batches, 1 << 20):
            window.append((block, fragments(block, length)))
            size += len(block.buf)
            if size >= WINDOW_BYTES:
                yield from settle(window, shard)
                size = 0
        yield from settle(window, shard)

    return run


# --- transforms ------------------------------------------------------------------------------


class Shard:
    """Suffixes of a shard's text (0 after each fragment, read in a circle) in order of their first 64 bytes, and its transform."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        around = np.resize(text, n + 8)  # the circle, eight bytes beyond its end
        key = np.zeros(n, np.uint64)
        for j in range(8):
            key = (key << np.uint64(8)) | around[j : n + j].astype(np.uint64)
        width = 8
        while True:
            self.order = np.argsort(key, kind="stable")
            sorted_ = key[self.order]
            rank = np.empty(n, np.uint64)
            rank[self.order] = np.cumsum(np.concatenate(([0], sorted_[1:] != sorted_[:-1])), dtype=np.uint64)
            if width >= LENGTH or int(rank.max(initial=0)) == n - 1:
                break
            key = (rank << np.uint64(32)) | np.roll(rank, -(width % n))
            width *= 2
        self.transform = text[self.order - 1]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes and the common prefix of each with the one before, up to depth.

    Pass h takes the interleave that is sorted by h bytes and puts the byte before each suffix in front: dealing the suffixes out
    by that byte, in order, sorts the interleave by h + 1 bytes. A boundary between neighbours stays where it is once set.
    """
    lengths = [len(s.transform) for s in shards]
    transforms = np.concatenate([s.transform for s in shards])
    order = np.repeat(np.arange(len(shards), dtype=np.uint8), lengths)
    n = len(order)
    common = np.full(n, depth, np.int16)
    common[0] = -1
    block = np.zeros(n, np.int32)
    before = np.empty(n, np.uint8)
    for h in range(depth):
        before[np.argsort(order, kind="stable")] = transforms
        dealt = np.argsort(before, kind="stable")
        order, byte, block = order[dealt], before[dealt], block[dealt]
        new = np.zeros(n, bool)
        new[1:] = (byte[1:] != byte[:-1]) | (block[1:] != block[:-1])
        common[new & (common == depth)] = h
        block = np.cumsum(new, dtype=np.int32)
    return order, common


def repeated(text: list[np.ndarray], frag: list[np.ndarray], offset: list[np.ndarray], doc: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, offset) of each string of `length` bytes that also occurs in a smaller document; text, fragment and offset by shard."""
    shards = [Shard(t) for t in text]
    order, common = merge(shards, length)
    base = np.cumsum([0] + [len(t) for t in text])
    suffix = np.empty(len(order), np.int64)
    suffix[np.argsort(order, kind="stable")] = np.concatenate([s.order + b for s, b in zip(shards, base)])
    f, o = np.concatenate(frag)[suffix], np.concatenate(offset)[suffix]
    interval = np.cumsum(common < length) - 1
    whole = o + length <= size[f]
    f, o, interval = f[whole], o[whole], interval[whole]
    if not len(f):
        return f, o
    starts = np.flatnonzero(np.diff(interval, prepend=-1))
    least = np.repeat(np.minimum.reduceat(doc[f], starts), np.diff(np.append(starts, len(f))))
    gone = doc[f] > least
    return f[gone], o[gone]


def _shared(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another document has the same key."""
    order = np.argsort(key, kind="stable")
    k, d = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    both = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
    out = np.empty(len(key), bool)
    out[order] = np.repeat(both, np.diff(np.append(starts, len(key))))
    return out


def _hash_at(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n bytes from each place."""
    h, u = np.zeros(len(at), np.uint64), _longs(data)
    for j in [*range(0, n - 8, 8), n - 8]:  # the last eight bytes may overlap those before
        h = mix(h + u[at + j])
    return h


def _pruned(data: np.ndarray, at: np.ndarray, size: np.ndarray, mark: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(offset, size) of the stretch of each fragment that may hold strings of other documents; size 0 where none can be.

    Strings with `low` to `high` bytes before their minimizer have the bytes from `low` before it on in common, length - (high - low) of
    them. Equal strings lie alike around it, so where no other document has these bytes, none of the strings is repeated. Each round asks
    this of what the one before left, with narrower ranges and so of more bytes.
    """
    low, high = np.maximum(mark + length - size, 0), np.minimum(mark, length - MINIMIZER)
    left = np.flatnonzero(low <= high)
    for step in ROUNDS:
        least, most = np.full(len(left), length), np.full(len(left), -1)
        for a in range(0, length - MINIMIZER + 1, step):
            b = min(a + step - 1, length - MINIMIZER)
            j = np.flatnonzero((low[left] <= b) & (high[left] >= a))
            f = left[j]
            j = j[_shared(_hash_at(data, at[f] + mark[f] - a, length - (b - a)), doc[f])] if len(f) else j
            least[j], most[j] = np.minimum(least[j], a), b
        low[left], high[left] = np.maximum(low[left], least), np.minimum(high[left], most)
        left = left[most >= 0]
    out, n = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    out[left], n[left] = mark[left] - high[left], length + high[left] - low[left]
    return out, n


def bucket_spans(parts: list[dict[str, np.ndarray]], shard_of: list[int], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, start, end) of what is removed, from all fragments of a bucket."""
    doc, size, mark, count, places = (np.concatenate([p[k] for p in parts]) for k in ("doc", "size", "mark", "count", "places"))
    data = np.concatenate([p["data"] for p in parts])
    shard = np.repeat(shard_of, [len(p["doc"]) for p in parts])
    at = np.cumsum(size) - size
    first_place = np.cumsum(count) - count
    hash_ = _hash_at(data, at + mark, MINIMIZER)
    digest = span_hashes(data, at, at + size, lower=False)
    order, first = _groups(digest, hash_)
    sizes = np.diff(np.append(first, len(order)))
    least = np.repeat(np.minimum.reduceat(doc[order], first), sizes)
    own = doc[order] == least

    def places_of(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = count[f]
        return np.repeat(np.arange(len(f)), n), places[np.arange(int(n.sum())) + np.repeat(first_place[f] - (np.cumsum(n) - n), n)]

    gone = order[~own]  # a smaller document has the whole fragment
    i, s = places_of(gone)
    yield doc[gone][i], s, s + size[gone][i]
    # one fragment of each group goes on, as its first document
    head = np.flatnonzero(own)
    group = np.repeat(np.arange(len(first)), sizes)
    chosen = head[np.concatenate(([True], group[head][1:] != group[head][:-1]))]
    reps = order[chosen]
    begin, size_ = _pruned(data, at[reps], size[reps], mark[reps], doc[reps], length)
    some, text, frag, offset = np.flatnonzero(size_), [], [], []
    for k in np.unique(shard[reps[some]] % SHARDS):
        f = some[shard[reps[some]] % SHARDS == k]
        n = size_[f]
        t = np.zeros(int((n + 1).sum()), np.uint8)
        o = np.arange(len(t)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
        t[o < np.repeat(n, n + 1)] = _gather(data, at[reps[f]] + begin[f], n)
        text.append(t)
        frag.append(np.repeat(f, n + 1))
        offset.append(o)
    if not text:
        return
    f, o = repeated(text, frag, offset, doc[reps], size_, length)
    if not len(f):
        return
    o = o + begin[f]
    # runs of strings of one fragment are one span, in all its places
    by = np.lexsort((o, f))
    f, o = f[by], o[by]
    new = np.concatenate(([True], (f[1:] != f[:-1]) | (o[1:] > o[:-1] + length)))
    cut = np.flatnonzero(new)
    f, s, e = f[cut], o[cut], np.maximum.reduceat(o, cut) + length
    # all fragments of the group that are of its first document
    members = order[own]
    member_rep = np.searchsorted(np.unique(group[head]), group[head])
    start = np.searchsorted(member_rep, f)
    n = np.searchsorted(member_rep, f, side="right") - start
    which = np.repeat(np.arange(len(f)), n)
    m = members[np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)]
    i, p = places_of(m)
    yield doc[m][i], p + s[which][i], p + e[which][i]


def _reduce(length: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = [np.frombuffer(zstandard.decompress(b), np.int64).reshape(3, -1) for b in part["blob"][part["kind"] == 1]]
        own = part[part["kind"] == 0].sort_values(["shard"], kind="stable")
        if len(own):
            out += [np.stack(x) for x in bucket_spans([_unpack(b) for b in own["blob"]], own["shard"].tolist(), length)]
        doc, s, e = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return pd.DataFrame({"doc_id": doc, "s": s.astype(np.int32), "e": e.astype(np.int32)})

    return run


def _minimizers(length: int):
    """(hash, bytes) of a sample's minimizers: the bytes of the distinct fragments around each, of those with any number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            f = fragments(block, length)
            order, first = _groups(f["digest"], f["hash"])
            head = order[first]
            hash_, of = np.unique(f["hash"][head], return_inverse=True)
            n = np.bincount(of, f["size"][head], len(hash_)).astype(np.int64)
            some = n > 2 * length
            yield pa.RecordBatch.from_arrays([pa.array(hash_[some].view(np.int64)), pa.array(n[some])], ["hash", "bytes"])

    return run


def minimizers_to_split(own: DataFrame, total: int, length: int) -> np.ndarray:
    """Hashes, in order, of the minimizers that would fill a good part of a bucket; at most SPLIT, the most frequent."""
    share = min(1.0, SAMPLE_BYTES / max(total, 1))
    some = own if share == 1 else own.sample(share, seed=1)
    n = some.mapInArrow(_minimizers(length), "hash long, bytes long").groupBy("hash").agg(F.sum("bytes").alias("bytes"))
    hot = n.where(F.col("bytes") > share * BUCKET_BYTES / 8).orderBy(F.desc("bytes"), "hash").limit(SPLIT)
    return np.sort(np.array([r[0] for r in hot.select("hash").collect()], np.int64).view(np.uint64))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, spans) of the bytes covered by strings of `length` bytes that also start in a document with a smaller doc_id."""
    own = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    split = minimizers_to_split(own, total, length) if length == LENGTH else np.zeros(0, np.uint64)
    sent = own.mapInArrow(_send(buckets, length, split), SENT)
    spans = sent.groupBy("bucket").applyInPandas(_reduce(length), SPANS)
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    return remove(docs, repeats(docs, length), with_text=True)


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return remove(docs, repeats(docs))


ORACLE_SQL = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) h, strlen(coalesce(text, '')) n from documents
), g as (
  select doc_id, i, substr(h, 2 * i + 1, 100) s from (select doc_id, h, unnest(range(0, n - 49)) i from d where n >= 50)
), m as (select s, min(doc_id) least from g group by s
), c as (select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 50 then 1 else 0 end new from g join m using (s) where doc_id > least
), r as (select doc_id, min(i) a, max(i) + 50 b from (select *, sum(new) over (partition by doc_id order by i) run from c) group by doc_id, run
), k as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) s, a e from r
  union all select d.doc_id, coalesce(max(b), 0), any_value(n) from d left join r using (doc_id) group by d.doc_id
), t as (select k.doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' order by s) kept from k join d using (doc_id) group by k.doc_id)
select d.doc_id, n::bigint n_bytes, (n - length(kept) // 2)::bigint n_removed, coalesce(x.spans, 0)::bigint n_spans, sha256(unhex(kept)) kept_sha256
from d join t using (doc_id) left join (select doc_id, count(*) spans from r group by doc_id) x using (doc_id)
"""
