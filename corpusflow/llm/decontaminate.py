"""Benchmark decontamination with suffix arrays over the training shards.

Every block of documents (a shard) gets a suffix array of its words; every suffix of every test item is
binary-searched in it. That gives the longest verbatim match and its place, and all places where a
window of `window` words occurs. Texts are never shuffled. The test items are sent to the executors
in groups of bounded size, one at a time, so a large benchmark means more passes, not a larger broadcast; results don't depend on the groups.

Words are compared by 64-bit hashes of their bytes (A-Z in lower case).

Defined results: null or empty text has no words and is clean; an item of fewer than `window` words is one
window, an item of none is ignored; items that share an item_id are one; rows of items without an id are left out; rows of documents are
judged one by one, those that share a doc_id and those whose id is null too; of two longest matches as long the group's and then the shard's first counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, Block, blocks, discard, lean, materialise, span_hashes, table, words

WINDOW = 10
#: Test items are broadcast in groups of at most this many bytes of text.
ITEMS_BYTES = 8 << 20

MATCHES = (
    "doc_id long, n_words long, n_hit long, item_ids array<string>, longest long, longest_item string, "
    "longest_item_word long, longest_doc_word long, hits binary"
)


class Suffixes:
    """A suffix array of a shard's words, ordered to a depth of at least `depth` words."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, depth: int):
        self.vocabulary, ranks = np.unique(hashes, return_inverse=True)
        n, docs = len(hashes), len(bounds) - 1
        # one sentinel, rank 0, after each document: no match passes it
        at = np.arange(n) + np.repeat(np.arange(docs), np.diff(bounds))
        self.tokens = np.zeros(n + docs, np.int64)
        self.tokens[at] = ranks + 1
        rank, order, k = self.tokens.astype(np.uint64), None, 1
        while k < depth:
            key = rank << np.uint64(32)
            key[:-k] |= rank[k:]
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])), dtype=np.uint64)
            k *= 2
        self.order = order if order is not None else np.argsort(rank, kind="stable")
        self.padded = np.append(self.tokens, np.zeros(depth, np.int64))

    def translate(self, hashes: np.ndarray) -> np.ndarray:
        """Ranks of the given word hashes, -1 where the shard has no such word."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of patterns, the range of suffixes that begin with its first `length` words."""
        depth = patterns.shape[1]
        cols = np.arange(depth)
        used = cols[None, :] < lengths[:, None]
        out = []
        for upper in (False, True):
            lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.order))
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                diff = np.where(used[open_], self.padded[self.order[mid][:, None] + cols] - patterns[open_], 0)
                first = (diff != 0).argmax(axis=1)
                sign = diff[np.arange(len(open_)), first]
                right = sign <= 0 if upper else sign < 0
                lo[open_] = np.where(right, mid + 1, lo[open_])
                hi[open_] = np.where(right, hi[open_], mid)
            out.append(lo)
        return out[0], out[1]

    def longest(self, lower: np.ndarray, items: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and place of the longest match of each test suffix items[at:]: with a neighbour of its place in the order."""
        best, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for step in (-1, 0):
            near = np.clip(lower + step, 0, len(self.order) - 1)
            start, length = self.order[near], np.zeros(len(at), np.int64)
            alive = np.arange(len(at))
            while len(alive):
                d, i = start[alive] + length[alive], at[alive] + length[alive]
                ok = (d < len(self.tokens)) & (i < len(items))
                ok &= self.tokens[np.minimum(d, len(self.tokens) - 1)] == items[np.minimum(i, len(items) - 1)]
                alive = alive[ok]
                length[alive] += 1
            place = np.where(length > best, start, place)
            best = np.maximum(best, length)
        return best, place


class Items:
    """Test items as word hashes; item k's words are followed by one hash that no document has."""

    def __init__(self, rows: list[tuple[str, str | None]], window: int):
        block = next(blocks([pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])], 1 << 40))
        s, e, bounds = words(block, ALNUM)
        hashes = span_hashes(block.buf, s, e)
        self.ids = [r[0] for r in rows]
        n = np.diff(bounds)
        self.first = bounds[:-1] + np.arange(len(rows))
        self.hashes = np.zeros(len(hashes) + len(rows), np.uint64)
        self.end = np.ones(len(self.hashes), bool)
        at = np.arange(len(hashes)) + np.repeat(np.arange(len(rows)), n)
        self.hashes[at], self.end[at] = hashes, False
        self.item = np.repeat(np.arange(len(rows)), n + 1)
        left = np.repeat(self.first + n, n + 1) - np.arange(len(self.item))  # words from here to the item's end
        need = np.minimum(np.repeat(n, n + 1), window)
        self.suffixes = np.flatnonzero(~self.end)
        self.lengths = np.minimum(left, window)[self.suffixes]
        self.is_window = ((left >= need) & (need > 0))[self.suffixes]


def scan_block(block: Block, items: Items, window: int) -> Iterator[tuple]:
    """A row of MATCHES for each document of a block."""
    s, e, bounds = words(block, ALNUM)
    docs, n = len(block.ids), len(s)
    cover = np.zeros(n + docs + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    best: dict[int, tuple[int, int, int]] = {}
    first_token = bounds[:-1] + np.arange(docs)
    if n and len(items.suffixes):
        shard = Suffixes(span_hashes(block.buf, s, e), bounds, window)
        ranks = shard.translate(items.hashes)
        ranks[items.end] = -1
        padded = np.append(ranks, np.full(window, -1))
        patterns = padded[items.suffixes[:, None] + np.arange(window)]
        lower, upper = shard.search(patterns, items.lengths)
        longest, place = shard.longest(lower, ranks, items.suffixes)
        doc_of = np.searchsorted(first_token, np.arange(n + docs), side="right") - 1
        for k in np.flatnonzero(longest):  # documents of the longest matches
            d = int(doc_of[place[k]])
            if longest[k] > best.get(d, (0, 0, 0))[0]:
                best[d] = int(longest[k]), int(items.suffixes[k]), int(place[k])
        for k in np.flatnonzero(items.is_window & (upper > lower)):
            where = shard.order[lower[k] : upper[k]]
            np.add.at(cover, where, 1)
            np.add.at(cover, where + items.lengths[k], -1)
            item = int(items.item[items.suffixes[k]])
            pairs.update((d, item) for d in np.unique(doc_of[where]).tolist())
    hit = np.cumsum(cover)[:-1] > 0
    of_doc: dict[int, list[int]] = {}
    for d, item in pairs:
        of_doc.setdefault(d, []).append(item)
    for d, doc_id in enumerate(block.ids):
        size = int(bounds[d + 1] - bounds[d])
        own = hit[first_token[d] : first_token[d] + size]
        length, item_at, token = best.get(d, (0, None, None))
        item = None if item_at is None else int(items.item[item_at])
        yield (
            doc_id, size, int(own.sum()), sorted({items.ids[i] for i in of_doc.get(d, ())}), length,
            None if item is None else items.ids[item], None if item is None else int(item_at - items.first[item]),
            None if token is None else int(token - first_token[d]), np.packbits(own).tobytes() if own.any() else b"",
        )


def _scan(broadcast, window: int, key: str):
    """A row of MATCHES for each row, with its key column in place of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = broadcast.value
        names = [x.split()[0] for x in MATCHES.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for block in blocks(batches, key=key):
            rows = list(zip(*scan_block(block, items, window)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], [key, *names[1:]])

    return run


def _groups(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """Test items in groups of bounded size, streamed partition by partition; one empty group if there are none."""
    group, size, any_ = [], 0, False
    for r in benchmark.select(F.col("item_id").cast("string"), "text").where("item_id is not null").toLocalIterator():
        n = len((r[1] or "").encode())
        if group and size + n > limit:
            yield group
            group, size, any_ = [], 0, True
        group.append((r[0], r[1]))
        size += n
    if group or not any_:
        yield group or [("", "")]


def _one_by_one(groups: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Each group, and whether it is the last."""
    group = next(groups)
    for following in groups:
        yield group, False
        group = following
    yield group, True


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, items_bytes: int = ITEMS_BYTES) -> DataFrame:
    """Per row of docs: its words, the words inside occurring windows (`hits`, a bit each), the distinct items they
    are from, and the longest verbatim match that a test suffix has in this document's shard, with its places.

    With one group of items this is one pass. More groups are passed over a written table in which each row has a number, so
    rows are merged by number and never by doc_id; a group's broadcast is destroyed before the next is sent.
    """
    spark = docs.sparkSession
    docs, parts, keyed = docs.select("doc_id", "text"), [], None
    for group, last in _one_by_one(_groups(benchmark, items_bytes)):
        sent = spark.sparkContext.broadcast(Items(group, window))
        if last and keyed is None:
            return docs.mapInArrow(lean(_scan(sent, window, "doc_id")), MATCHES)
        if keyed is None:
            keyed = materialise(docs.withColumn("row", F.monotonically_increasing_id()))
        found = keyed.select("row", "text").mapInArrow(lean(_scan(sent, window, "row")), MATCHES.replace("doc_id", "row", 1))
        parts.append(materialise(found if not parts else found.where("n_hit > 0 or longest > 0")))
        sent.destroy()
    ids = materialise(keyed.select("row", "doc_id"))
    discard(keyed)
    return ids.join(_merge(parts), "row").drop("row")


def _merge(parts: list[DataFrame]) -> DataFrame:
    """One row per row number from the passes over groups of items."""
    both = parts[0]
    for p in parts[1:]:
        both = both.union(p)
    merged = both.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.max(F.struct("longest", "longest_item", "longest_item_word", "longest_doc_word")).alias("x"),
        F.collect_list("hits").alias("h"),
    )
    return merged.withColumn("u", F.pandas_udf(_united, "n long, hits binary")("h")).select("row", "n_words", F.col("u.n").alias("n_hit"), "item_ids", "x.*", "u.hits")


def _united(lists: pd.Series) -> pd.DataFrame:
    """The union of bit sets, and its size."""
    out = []
    for parts in lists:
        bits = np.zeros(max((len(p) for p in parts), default=0), np.uint8)
        for p in parts:
            bits[: len(p)] |= np.frombuffer(p, np.uint8)
        out.append((int(np.unpackbits(bits).sum()), bits.tobytes()))
    return pd.DataFrame(out, columns=["n", "hits"])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, items_bytes: int = ITEMS_BYTES) -> DataFrame:
    """docs without the rows that hold a window of a test item, judged in the scan and row by row, whatever their doc_id; all columns kept."""

    def kept(broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = broadcast.value
            for batch in batches:
                rows = pa.RecordBatch.from_arrays([pa.array(range(len(batch)), pa.int64()), batch.column("text")], ["doc_id", "text"])
                ok = [r[2] == 0 for block in blocks([rows]) for r in scan_block(block, items, window)]
                yield batch.filter(pa.array(ok, pa.bool_()))

        return run

    for group, last in _one_by_one(_groups(benchmark, items_bytes)):
        sent = docs.sparkSession.sparkContext.broadcast(Items(group, window))
        docs = docs.mapInArrow(lean(kept(sent)), docs.schema)
        if not last:
            docs = materialise(docs)
            sent.destroy()
    return docs


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return m.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
), b as (
  select cast(item_id as varchar) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark
), iw as (
  select distinct item, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') g
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)
), lens as (select distinct n from iw
), dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, lens where len(w) >= n)
), occ as (select doc_id, i, dw.n, item from dw join iw on dw.n = iw.n and dw.g = iw.g
), hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from occ) group by 1
), its as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) l from (select distinct doc_id, item from occ) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (doc_id) left join its using (doc_id)
"""
