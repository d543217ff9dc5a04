"""Embedding near-dedup by collision counting over one-dimensional projections.

Unit vectors get many random projections. In a group of vectors each projection is sorted, and a query-centred
window on it collides the query with its neighbours; a pair that collides on at least a recall-calibrated number of
projections is verified by its cosine in double precision.

One projection alone keeps a fixed share of all pairs, so groups are cells of random grids over a few further
projections: the number of projections in a grid grows with the logarithm of the number of vectors, and the
number of grids follows from the recall asked for at the threshold itself (pairs above it do better). A copy of a vector carries
nothing but the vector. A pair is counted in the first grid only whose cell it shares (cells are computed again for the vectors of
verified pairs), so links are counted, and joined to groups, inside the tasks and pairs never leave them. A cell of very
many vectors is split into pairs of chunks.

Equal vectors are one node with a count. Defined results: vectors that are null, empty or zero or hold null or
non-finite components link with nothing and are their own component; vectors of different lengths don't link;
rows whose vec_id is null are left out; repeated rows count once; vectors that share a vec_id
are one node, a row each with the links of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Forest, connected_components, materialise, table

THRESHOLD = 0.9
#: Projections on which collisions are counted, half the window in standard deviations of a pair at the threshold,
#: and the recall for which the count, and the number of grids, are calibrated.
PROJECTIONS, WINDOW, RECALL = 24, 2.0, 0.999
#: Width of a grid's cells on each of its projections; vectors that a cell should hold; rows of a chunk.
WIDTH, CELL, CHUNK = 2.0, 256, 1024
SEED = 11


class Plan:
    """All numbers that follow from the threshold, the recall and the number of vectors."""

    def __init__(self, n: int, threshold: float):
        self.threshold = threshold
        far = math.sqrt(2 - 2 * threshold)  # distance of a pair at the threshold
        self.half = WINDOW * far
        self.count = _quantile(PROJECTIONS, math.erf(WINDOW / math.sqrt(2)), 1 - RECALL)
        near, random = _same_cell(far), _same_cell(math.sqrt(2))
        self.depth = max(1, round(math.log(max(1.0, n / CELL)) / math.log(1 / random))) if n > CELL else 1
        self.grids = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near**self.depth)))
        self._made: dict[int, tuple] = {}

    def matrices(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if dim not in self._made:
            rng = np.random.Generator(np.random.PCG64([SEED, dim]))
            self._made[dim] = (
                rng.standard_normal((dim, PROJECTIONS)),
                np.rint(rng.standard_normal((dim, self.grids * self.depth)) * 2**16),
                rng.random(self.grids * self.depth) * WIDTH,
            )
        return self._made[dim]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit cell id for each vector and grid; sums of whole numbers, so it doesn't depend on the vectors beside it."""
        _, directions, shifts = self.matrices(unit.shape[1])
        at = np.floor((np.rint(unit * 2**16) @ directions / 2.0**32 + shifts) / WIDTH).astype(np.int64).reshape(len(unit), self.grids, self.depth)
        h = np.full(at.shape[:2], unit.shape[1], np.uint64)
        for k in range(self.depth):
            h = (h ^ at[:, :, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)


def _same_cell(distance: float) -> float:
    """Chance that two points at this distance share a cell on one projection."""
    x = np.linspace(0, WIDTH, 20001)
    density = 2 * np.exp(-((x / distance) ** 2) / 2) / (distance * math.sqrt(2 * math.pi))
    return float(np.sum(density * (1 - x / WIDTH)) * (x[1] - x[0]))


def _quantile(m: int, p: float, tail: float) -> int:
    """The largest count that a binomial variable reaches with a chance of at least 1 - tail."""
    below = 0.0
    for k in range(m + 1):
        below += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if below > tail:
            return k
    return m


def candidates(proj: np.ndarray, half: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a < b of a group that collide on at least `count` projections.

    Each projection is sorted, and what lies in the window around a query is a range of places in that order. Half of the
    projections are counted for all places; a pair that the other half can't bring to `count` any more is dropped, the
    others are counted on.
    """
    n, m = proj.shape
    ranks, lows, sizes = (np.empty((m, n), np.int32) for _ in range(3))
    for j in range(m):
        x = proj[:, j]
        order = np.argsort(x)
        sorted_ = x[order]
        ranks[j, order] = np.arange(n)
        lows[j] = np.searchsorted(sorted_, x - half)
        sizes[j] = np.searchsorted(sorted_, x + half, side="right") - lows[j]
    first, found = m // 2, []
    rows = max(1, (1 << 20) // n)
    for at in range(0, n, rows):  # a slice of queries at a time
        q = slice(at, at + rows)
        counts = np.zeros((len(lows[0, q]), n), np.uint8)
        for j in range(first):
            counts += (ranks[j][None, :] - lows[j, q, None]).view(np.uint32) < sizes[j, q, None].view(np.uint32)
        a, b = np.nonzero(counts >= count - (m - first))
        own = counts[a, b]
        a += at
        up = a < b
        a, b, own = a[up], b[up], own[up]
        for j in range(first, m):
            own += (ranks[j][b] - lows[j][a]).view(np.uint32) < sizes[j][a].view(np.uint32)
            alive = own >= count - (m - 1 - j)
            a, b, own = a[alive], b[alive], own[alive]
        found.append((a, b))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


# --- tasks -----------------------------------------------------------------------------------

ROWS = "grid int, cell long, node long, n long, v binary"
#: Components of vectors that are multiplied at once.
SLICE = 1 << 22


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow, no underflow
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _unpacked(vectors: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision."""
    kinds = {x[:1] for x in vectors}
    if len(kinds) == 1:
        kind = np.float32 if kinds == {b"4"} else np.float64
        raw = np.frombuffer(b"".join([x[1:] for x in vectors]), kind).reshape(len(vectors), -1)
    else:
        raw = np.stack([np.frombuffer(x, np.float32 if x[:1] == b"4" else np.float64, -1, 1) for x in vectors])
    return _unit(raw.astype(np.float64))


def _rows(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                node, n = part.column(0).to_numpy(), part.column(1).to_numpy()
                lists = part.column(2)
                sizes = lists.value_lengths().to_numpy()
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                first = np.cumsum(sizes) - sizes
                for dim in np.unique(sizes):
                    own = np.flatnonzero(sizes == dim)
                    raw = values[first[own][:, None] + np.arange(dim)]
                    cells = plan.cells(_unit(raw))
                    with np.errstate(over="ignore"):
                        half = raw.astype(np.float32)
                    # vectors of single precision travel as such: nothing is lost, and half is moved
                    vectors = [b"4" + x.tobytes() for x in half] if np.array_equal(half.astype(np.float64), raw) else [b"8" + x.tobytes() for x in raw]
                    for g in range(plan.grids):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), g, np.int32)), pa.array(cells[:, g]), pa.array(node[own]), pa.array(n[own]), pa.array(vectors, pa.binary())],
                            [x.split()[0] for x in ROWS.split(", ")],
                        )

    return run


def _count(plan: Plan):
    """(a, b, linked): b more links of node a, or, if linked, a link between a and b that joins two groups."""

    def group(g: int, chunk: np.ndarray, ij: tuple, node: np.ndarray, n: np.ndarray, v: list) -> Iterator[tuple]:
        unit = _unpacked(v)
        a, b = candidates(unit @ plan.matrices(unit.shape[1])[0], plan.half, plan.count)
        if ij[0] != ij[1]:  # two chunks: their cross pairs only
            across = chunk[a] != chunk[b]
            a, b = a[across], b[across]
        step = max(1, SLICE // unit.shape[1])
        sure = [np.einsum("ij,ij->i", unit[a[i : i + step]], unit[b[i : i + step]]) >= plan.threshold for i in range(0, len(a), step)]
        if sure:
            sure = np.concatenate(sure)
            a, b = a[sure], b[sure]
        if g and len(a):  # the first grid whose cell they share counts a pair
            some = np.unique(np.concatenate((a, b)))
            ids = plan.cells(unit[some])[:, :g]
            new = [~(ids[np.searchsorted(some, a[i : i + step])] == ids[np.searchsorted(some, b[i : i + step])]).any(axis=1) for i in range(0, len(a), step)]
            new = np.concatenate(new)
            a, b = a[new], b[new]
        if not len(a):
            return
        links = np.bincount(a, n[b], len(node)) + np.bincount(b, n[a], len(node))
        some = np.flatnonzero(links)
        forest = Forest(len(node))
        forest.add(a, b)
        yield node[some], links[some].astype(np.int64), np.zeros(len(some), bool)
        pairs = np.array(forest.links)
        yield node[pairs[:, 0]], node[pairs[:, 1]], np.ones(len(pairs), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("grid", "cell", "i", "j")
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            if sum(map(len, held)) < 2:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            c = {x: t.column(x).to_numpy() for x in ("grid", "chunk", "i", "j", "node", "n")}
            for out in group(int(c["grid"][0]), c["chunk"], (c["i"][0], c["j"][0]), c["node"], c["n"], t.column("v").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["a", "b", "linked"])

        for batch in batches:
            cols = [batch.column(x).to_numpy() for x in names]
            new = np.concatenate(([True], np.any([x[1:] != x[:-1] for x in cols], axis=0))) if len(batch) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            for s, e in zip(starts, np.append(starts[1:], len(batch))):
                key = tuple(int(x[s]) for x in cols)
                if key != last:
                    yield from flush()
                    held.clear()
                    last = key
                held.append(batch.slice(s, e - s))
        yield from flush()

    return run


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id) of every (vec_id, embedding)."""
    each = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null").distinct()
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce((F.size("e") > 0) & finite & F.exists("e", lambda x: x != 0), F.lit(False))
    nodes = materialise(each.where(good).groupBy("e").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")))
    plan = Plan(nodes.count(), threshold)
    rows = nodes.select("node", "n", "e").mapInArrow(_rows(plan), ROWS)
    # a cell of more than CHUNK vectors is split: each pair of chunks i <= j is a group
    sizes = nodes.select("node", "n", "e").mapInArrow(_cell_ids(plan), "g int, c long").groupBy("g", "c").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK)
    sizes = materialise(sizes.select("g", "c", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    if sizes.isEmpty():
        split = rows.withColumns({"chunk": F.lit(0), "i": F.lit(0), "j": F.lit(0)})
    else:
        all_ = rows.join(sizes, (rows["grid"] == sizes["g"]) & (rows["cell"] == sizes["c"]), "left").drop("g", "c")
        all_ = all_.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        split = all_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        split = split.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("other", "chunks")
    keys = ["grid", "cell", "i", "j"]
    found = materialise(split.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_count(plan), "a long, b long, linked boolean"))
    component = connected_components(found.where("linked").select("a", "b"))
    counts = found.where("not linked").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    of = nodes.join(counts, "node", "left").join(component, "node", "left")
    of = of.select(F.col("e").alias("e2"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = each.where(good).join(of, F.col("e") == F.col("e2")).select("vec_id", "n_links", "component_id")
    return linked.unionByName(each.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def _cell_ids(plan: Plan):
    rows = _rows(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows(batches):
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], ["g", "c"])

    return run


def op1_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


ORACLE_SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) e from embeddings where embedding is not null
), p as (
  select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9
), r as (
  select vec_id n, vec_id m from v union select r.n, p.b from r join p on p.a = r.m
), c as (select n, min(m) m from r group by n), k as (select a, count(*) l from p group by a)
select vec_id, cast(coalesce(l, 0) as bigint) n_links, coalesce(m, vec_id) component_id, coalesce(m, vec_id) = vec_id kept
from embeddings left join c on n = vec_id left join k on a = vec_id
"""
