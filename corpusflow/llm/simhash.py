"""SimHash near-dedup by anchor-point covering.

The fingerprint is cut into bands. In each band the words of a linear code (a Hamming code, covering
radius 1) are the anchors. A fingerprint is at home at its nearest anchor and is replicated to every anchor
within the covering radius plus the band's threshold, so two fingerprints within that threshold in a band meet
at the home anchor of either. With b bands and threshold t in each, all pairs within b*(t+1)-1 bits meet.
Fingerprints are compared anchor by anchor; only links that join two groups leave a task, never all pairs.
An anchor with very many fingerprints is split into pairs of chunks.

near_duplicates() finds texts whose sets of five-word shingles have a similarity of 0.8 or more: fingerprints of 256 bits give
candidates, and a link counts only if the shingles of its two texts confirm it; none stands for another until it is confirmed. The bands grow wider with the
logarithm of the number of texts and there are more of them, so comparisons grow with about the 1.3th power of the texts.

Equal fingerprints (there: equal sets of shingles) are one node, so copies cost one row. Defined results: null or empty text has
fingerprint zero, which links like any other, and no shingles, as all such texts have; rows whose doc_id is null are left out; repeated
rows are kept; rows that share a doc_id are one node, of which the set with the smallest digest is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, connected_components, lean, materialise, table

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Homes of one anchor that are compared in one task; more are split.
CHUNK = 4096
#: Comparisons made at once.
SLICE = 1 << 21


# --- fingerprints ----------------------------------------------------------------------------


def shingles(text: bytes, n: int) -> list[bytes]:
    """The n-word shingles of a text, repeats included; of fewer words, all of them; of none, nothing."""
    words = text.translate(_LOWER).split()  # exactly [^\x20\x09-\x0D]+
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - n + 1]
    return [joined[a:b] for a, b in zip(starts.tolist(), (ends[n - 1 :] - 1).tolist())]


def _hashes(own: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, seed) for s in own], np.uint64)


def fingerprint(text: bytes, shingle: int, lanes: int = 1) -> list[int]:
    """A fingerprint of 64 bits a lane (lane k hashes with seed 42 + k), and a digest of the set of shingles."""
    own = shingles(text, shingle)
    if not own:
        return [0] * (lanes + 1)
    out, digest = [], 0
    for lane in range(lanes):
        h = _hashes(own, 42 + lane)
        if lane == 0:
            digest = xxhash.xxh64_intdigest(np.unique(h).tobytes())
        ones = np.zeros(64, np.int64)
        for i in range(0, len(h), 1 << 16):
            ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0]))
    return [*out, digest]


def fingerprints(docs: DataFrame, shingle: int, lanes: int = 1) -> DataFrame:
    """(doc_id, f0, f1, ..., digest): one long a lane."""
    columns = [*names(lanes), "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = [fingerprint(block.raw(k), shingle, lanes) for k in range(len(block.ids))]
            cols = [np.array(c, np.uint64).view(np.int64) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), *map(pa.array, cols)], ["doc_id", *columns])

    schema = "doc_id long, " + ", ".join(f"{f} long" for f in columns)
    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(lean(run), schema)


def names(lanes: int) -> list[str]:
    return [f"f{k}" for k in range(lanes)]


# --- the covering code -----------------------------------------------------------------------


class Code:
    """A Hamming code on `width` bits (columns 1, 2, 3, ... of the parity check; bits beyond are free)."""

    radius = 1

    def __init__(self, width: int, threshold: int):
        checks = (width + 1).bit_length() - 1
        column = [i + 1 if i + 1 < 1 << checks else 0 for i in range(width)]
        self.width, self.columns = width, np.array(column)
        by: dict[int, list[int]] = {s: [] for s in range(1 << checks)}
        for weight in range(self.radius + threshold + 1):
            for bits in combinations(range(width), weight):
                s = 0
                for b in bits:
                    s ^= column[b]
                by[s].append(sum(1 << b for b in bits))
        most = max(map(len, by.values()))
        self.patterns = np.full((1 << checks, most), -1, np.int64)  # anchors of a word with this syndrome, as differences
        for s, p in by.items():
            self.patterns[s, : len(p)] = p
        self.home = np.array([0] + [1 << column.index(s) for s in range(1, 1 << checks)], np.int64)

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        s = np.zeros(len(words), np.int64)
        for b in range(self.width):
            s ^= np.where((words >> b) & 1, self.columns[b], 0)
        return s


#: A band's width where there are few texts, and log2 of the texts for each bit that it is wider.
WIDTH, TEXTS = 16, 18
#: Recall at the similarity asked for, of the bands and of the distance.
RECALL, DEVIATIONS = 0.98, 2.8


def differing(similarity: float) -> float:
    """Share of fingerprint bits that differ between two sets as large of this similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan(n: int, similarity: float, bits: int, threshold: int = 1) -> tuple[int, int, int]:
    """(bands, width, distance) for n texts: a band is a bit wider each time that texts double, and bands make up for it."""
    width = min(40, max(WIDTH, WIDTH + math.ceil(math.log2(max(n, 1))) - TEXTS))
    far = differing(similarity)
    meet = sum(math.comb(width, k) * far**k * (1 - far) ** (width - k) for k in range(threshold + 1))
    bands = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))
    return bands, width, int(bits * far + DEVIATIONS * math.sqrt(bits * far * (1 - far)))


def band_bits(bands: int, width: int, bits: int) -> list[np.ndarray]:
    """The bits of each band: bands side by side while there are bits, then over shuffled bits."""
    rng, out, order = np.random.Generator(np.random.PCG64(7)), [], np.arange(bits)
    while len(out) < bands:
        out += [order[k * width : (k + 1) * width] for k in range(bits // width)]
        order = rng.permutation(bits)
    return out[:bands]


def _replicas(lanes: int, bands: int, width: int, threshold: int):
    code = Code(width, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = band_bits(bands, width, 64 * lanes)
        for batch in batches:
            for i in range(0, len(batch), 8192):
                part = batch.slice(i, 8192)
                fs = [part.column(1 + k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(lanes)]
                node = part.column(0).to_numpy(zero_copy_only=False)
                for band in range(bands):
                    word = np.zeros(len(node), np.int64)
                    for place, bit in enumerate(chosen[band].tolist()):
                        word |= ((fs[bit // 64].view(np.uint64) >> np.uint64(bit % 64)).astype(np.int64) & 1) << place
                    s = code.syndrome(word)
                    diff = code.patterns[s]
                    row, col = np.nonzero(diff >= 0)
                    diff = diff[row, col]
                    key = (np.int64(band) << np.int64(56)) | (word[row] ^ diff)
                    at_home = diff == code.home[s[row]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(at_home), pa.array(node[row]), *(pa.array(f[row]) for f in fs)],
                        ["key", "home", "node", *names(lanes)],
                    )

    return run


# --- comparison at the anchors ---------------------------------------------------------------


def _compare(lanes: int, levels: list[int]):
    """Links (a, b) that join groups, from batches sorted by anchor; a group may go on in the next batch.

    Levels are distances in rising order. A link is sent if it joins two groups of its own level, so near links are sent
    whatever farther ones came before, and the links up to each level give that level's groups.
    """
    distance = levels[-1]

    def links(cols: dict[str, np.ndarray], forest: dict) -> None:
        key, home = cols["group"], cols["home"]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        group = np.repeat(np.arange(len(first)), size)
        h = np.flatnonzero(home & (size[group] > 1))
        if not len(h):
            return
        n = size[group[h]]
        done = np.cumsum(n)
        at = 0
        while at < len(h):  # whole homes, about SLICE comparisons at once
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + SLICE, side="right")))
            own, m = h[at:to], n[at:to]
            left = np.repeat(own, m)
            right = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[group[own]], m)
            at = to
            d = np.zeros(len(left), np.uint16)
            ok = left != right
            for f in names(lanes):
                d += np.bitwise_count(cols[f][left] ^ cols[f][right])
            ok &= d <= distance
            own_ = np.flatnonzero(ok)
            own_ = own_[np.argsort(d[own_], kind="stable")]  # near links first
            level = np.searchsorted(levels, d[own_])
            for x, y, k in zip(cols["node"][left[own_]].tolist(), cols["node"][right[own_]].tolist(), level.tolist()):
                if x != y and _join(forest["parent"][k], x, y):
                    forest["links"].append((x, y))
                    for above in forest["parent"][k + 1 :]:
                        _join(above, x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, forest = None, {"parent": [{} for _ in levels], "links": []}
        for batch in batches:
            cols = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names)}
            cols = {c: v.view(np.uint64) if c in names(lanes) else v for c, v in cols.items()}
            cols["group"] = _group_numbers(cols)
            if rest is not None:
                same = all(rest[c][-1] == cols[c][0] for c in ("key", "i", "j"))
                cols["group"] = cols["group"] + (rest["group"][-1] + (0 if same else 1))
                cols = {c: np.concatenate((rest[c], cols[c])) for c in cols}
            cut = int(np.searchsorted(cols["group"], cols["group"][-1])) if len(cols["group"]) else 0
            links({c: v[:cut] for c, v in cols.items()}, forest)
            rest = {c: v[cut:] for c, v in cols.items()}
            if len(forest["parent"][-1]) > 200_000:  # bounded memory; fewer links are left out, none is lost
                yield from _flush(forest)
        if rest is not None:
            links(rest, forest)
        yield from _flush(forest)

    return run


def _group_numbers(cols: dict[str, np.ndarray]) -> np.ndarray:
    new = np.zeros(len(cols["key"]), bool)
    for c in ("key", "i", "j"):
        new[1:] |= cols[c][1:] != cols[c][:-1]
    return np.cumsum(new)


def _join(p: dict, x: int, y: int) -> bool:
    """Union of the groups of x and y; whether they were two."""
    rx, ry = x, y
    while (up := p.setdefault(rx, rx)) != rx:
        p[rx] = p[up]
        rx = up
    while (up := p.setdefault(ry, ry)) != ry:
        p[ry] = p[up]
        ry = up
    if rx != ry:
        p[max(rx, ry)] = min(rx, ry)
    return rx != ry


def _flush(forest: dict) -> Iterator[pa.RecordBatch]:
    a, b = zip(*forest["links"]) if forest["links"] else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    forest["parent"], forest["links"] = [{} for _ in forest["parent"]], []


def links(nodes: DataFrame, lanes: int, bands: int, width: int, threshold: int, distance: int, levels: tuple[int, ...] = ()) -> DataFrame:
    """Links (a, b) between the nodes (node, f0, ...), enough of them to give all groups at `distance` and at each of the smaller levels."""
    rows = nodes.select("node", *names(lanes)).mapInArrow(
        _replicas(lanes, bands, width, threshold),
        "key long, home boolean, node long, " + ", ".join(f"{f} long" for f in names(lanes)),
    )
    # an anchor of more than CHUNK rows is split: each pair of a home chunk i and a replica chunk j is a group
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    sizes = materialise(sizes.select(F.col("key").alias("hot"), F.ceil(F.col("n") / CHUNK).cast("int").alias("c")))
    if sizes.isEmpty():
        split = rows.withColumns({"i": F.lit(0), "j": F.lit(0)})
    else:
        chunk = F.pmod(F.xxhash64("node"), F.col("c")).cast("int")
        every = F.sequence(F.lit(0), F.col("c") - 1)
        all_ = rows.join(sizes, rows["key"] == sizes["hot"], "left").withColumn("c", F.coalesce("c", F.lit(1))).drop("hot")
        homes = all_.where("home").withColumn("i", chunk).withColumn("j", F.explode(every))
        others = all_.where("not home or c > 1").withColumn("home", F.lit(False)).withColumn("j", chunk).withColumn("i", F.explode(every))
        split = homes.unionByName(others).drop("c")
    sorted_ = split.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_.mapInArrow(lean(_compare(lanes, [*levels, distance])), "a long, b long")


def groups(docs: DataFrame, shingle: int, lanes: int, bands: int, width: int, threshold: int, distance: int) -> DataFrame:
    """(doc_id, f0, ..., component_id): component_id is the smallest doc_id reachable by links of at most `distance` bits."""
    fs = names(lanes)
    each = materialise(fingerprints(docs, shingle, lanes))
    nodes = each.groupBy(*fs).agg(F.min("doc_id").alias("node"))
    component = connected_components(links(nodes, lanes, bands, width, threshold, distance))
    of = nodes.join(component, "node", "left").select(*fs, F.coalesce("component", "node").alias("component_id"))
    return each.join(of, fs).select("doc_id", *fs, "component_id")


# --- near duplicates -------------------------------------------------------------------------

SHINGLE, SIMILARITY, LANES = 5, 0.8, 4


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, digest, shingles): the sorted hashes of each text's shingles, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            whole = [np.unique(_hashes(shingles(block.raw(k), shingle), 42)) for k in range(len(block.ids))]
            digest = np.array([xxhash.xxh64_intdigest(x.tobytes()) if len(x) else 0 for x in whole], np.uint64).view(np.int64)
            own = [np.unique(x.astype(np.uint32)).tobytes() for x in whole]
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(digest), pa.array(own, pa.large_binary()).cast(pa.binary())], ["doc_id", "digest", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), "doc_id long, digest long, shingles binary")


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2), batch.column(3)):
            s, t = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
            both = len(np.intersect1d(s, t, assume_unique=True))
            out.append(both / max(1, len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])


def _confirmed(found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) between texts of this similarity or more."""
    first = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t"))
    pairs = found.join(first, "a").join(second, "b").select("a", "b", "s", "t")
    return pairs.mapInArrow(lean(_similarity), "a long, b long, similarity double").where(F.col("similarity") >= similarity).select("a", "b")


#: Texts of one cluster that may be compared in one task, whatever its size; a text counts once for each WEIGHED bytes of shingles.
DEALT = 512
WEIGHED = 4096


def _dealt(nodes: DataFrame) -> DataFrame:
    """(pair, second, node, of, f0, ...): the clusters (`around`) of more than one group (`of`), as pairs of chunks that may be compared apart.

    A cluster of n has chunks of 16 sqrt(n) nodes (`weight` counts a long text as several), so a node is in about sqrt(n) / 16 pairs. A group
    larger than a chunk has chunks of its own, and pairs of these are left out: nothing in them is open.
    """
    of = nodes.groupBy("around", "of").agg(F.sum("weight").alias("m"))
    around = of.groupBy("around").agg(F.sum("m").alias("n"), F.count("*").alias("k")).where("k > 1")
    full = F.greatest(F.lit(DEALT), F.ceil(F.sqrt(F.col("n") * DEALT / 2)))
    sizes = of.join(around, "around").select("of", F.col("m"), F.col("n"), full.alias("full"))
    own = F.col("m") > F.col("full")
    number = F.when(own, F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / F.col("full")))).otherwise(F.pmod(F.xxhash64("of"), F.ceil(F.col("n") / F.col("full"))))
    chunk = F.struct(own.alias("own"), F.when(own, F.col("of")).otherwise(F.col("around")).alias("owner"), number.alias("number"))
    dealt = materialise(nodes.join(sizes, "of").withColumn("chunk", chunk).drop("m", "n", "full", "weight"))
    chunks = dealt.select("around", "chunk").distinct()
    pairs = chunks.withColumnRenamed("chunk", "i").join(chunks.withColumnRenamed("chunk", "j"), "around")
    pairs = pairs.where("i <= j and not (i.own and j.own and i.owner = j.owner)").withColumn("pair", F.monotonically_increasing_id())
    sides = materialise(pairs).select("pair", F.explode(F.array_distinct(F.array("i", "j"))).alias("chunk"), "i")
    return dealt.join(sides, "chunk").withColumn("second", F.col("chunk") != F.col("i")).drop("around", "chunk", "i")


def _joining(lanes: int, distance: int, similarity: float):
    """The confirmed links (a, b) that join groups (`of`), from a pair of chunks: all its pairs of nodes of different groups are asked."""

    def run(pair: pa.Table) -> pa.Table:
        pair = pair.sort_by([("second", "ascending"), ("node", "ascending")])
        node, of = pair["node"].to_pylist(), pair["of"].to_numpy()
        f = np.stack([pair[c].to_numpy().view(np.uint64) for c in names(lanes)])
        own = [np.frombuffer(v.as_buffer(), np.uint32) for v in pair["shingles"]]
        size = np.array([len(x) for x in own], np.int64)
        start = np.cumsum(size) - size
        code = np.unique(np.concatenate(own), return_inverse=True)[1]
        group = np.unique(of, return_inverse=True)[1]
        marked = np.zeros(len(code) + 1, bool)
        seconds = int(np.sum(pair["second"].to_numpy(zero_copy_only=False)))
        firsts = len(node) - seconds
        a, b = [], []
        for x in range(firsts):
            y = np.arange(firsts if seconds else x + 1, len(node))
            y = y[group[y] != group[x]]
            y = y[np.minimum(size[y], size[x]) / np.maximum(1, np.maximum(size[y], size[x])) >= similarity]
            y = y[np.bitwise_count(f[:, y] ^ f[:, x, None]).sum(axis=0, dtype=np.int64) <= distance]
            marked[code[start[x] : start[x] + size[x]]] = True
            while len(y):  # about SLICE shingles at once
                now, y = np.split(y, [max(1, int(np.searchsorted(np.cumsum(size[y]), SLICE)))])
                first = np.cumsum(size[now]) - size[now]
                at = np.arange(size[now].sum()) + np.repeat(start[now] - first, size[now])
                both = np.add.reduceat(marked[code[at]], first, dtype=np.int64)
                for z in now[both / (size[now] + size[x] - both) >= similarity].tolist():
                    if group[z] != group[x]:
                        a.append(node[x])
                        b.append(node[z])
                        group[group == group[z]] = group[x]
                y = y[group[y] != group[x]]
            marked[code[start[x] : start[x] + size[x]]] = False
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, lanes: int = LANES) -> DataFrame:
    """(doc_id, component_id): component_id is the smallest doc_id reachable by links between texts of this similarity or more.

    Links that would join two groups are searched by fingerprints, at two levels of distance and near ones first, and confirmed by the
    shingles, compared as 32-bit hashes: a chance match moves a similarity by less than 0.001. All candidates lie inside the clusters
    that the links made before they were confirmed; where a cluster has more than one group now, its texts are compared with each
    other where they lie, and only confirmed links that join two groups leave a task.
    """
    fs = names(lanes)
    each = materialise(fingerprints(docs, shingle, lanes))
    nodes = materialise(each.groupBy(*fs, "digest").agg(F.min("doc_id").alias("node")))
    bands, width, distance = plan(nodes.count(), similarity, 64 * lanes)
    mean = int(64 * lanes * differing(similarity))
    found = materialise(links(nodes, lanes, bands, width, 1, distance, (mean + 4,)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    linked = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    own = docs.join(linked, docs["doc_id"] == linked["id"], "left_semi")
    sets = materialise(_sets(own, shingle).groupBy("doc_id").agg(F.min_by("shingles", "digest").alias("shingles")))
    sure = materialise(_confirmed(found, sets, similarity))
    # a link that wasn't confirmed has stood for others of its cluster: all that are left between different groups are asked
    around = connected_components(found).withColumnRenamed("component", "around")
    weight = sets.select(F.col("doc_id").alias("node"), F.ceil((F.octet_length("shingles") + 1) / WEIGHED).alias("weight"))
    clusters = nodes.join(around, "node").join(weight, "node").join(connected_components(sure), "node", "left")
    clusters = materialise(clusters.select("node", *fs, "weight", "around", F.coalesce("component", "node").alias("of")))
    pairs = _dealt(clusters).join(sets.withColumnRenamed("doc_id", "node"), "node")
    left = pairs.groupBy("pair").applyInArrow(_joining(lanes, distance, similarity), "a long, b long")
    component = connected_components(sure.union(left))
    of = nodes.join(component, "node", "left").select(*fs, "digest", F.coalesce("component", "node").alias("component_id"))
    return each.join(of, [*fs, "digest"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """docs without the near duplicates of a document with a smaller doc_id; of rows that share an id, all stay."""
    gone = near_duplicates(docs, **parameters).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone_id"], "left_anti")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = groups(table(spark, sf_dir, "documents"), shingle=3, lanes=1, bands=2, width=32, threshold=1, distance=3)
    return g.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
