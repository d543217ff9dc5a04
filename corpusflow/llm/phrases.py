"""Phrase collocation mining with compressed position bitmaps.

Texts of one language are gathered into shards of bounded size. A shard numbers its word positions, with a gap between pieces,
and keeps a bitmap of positions for each word, as (block of 16 positions, bits) for the blocks that aren't empty. A phrase is
extended by a shift and an AND: the bitmap of its ends, moved on by one, against the bitmaps of words in the same blocks. What is
left is the bitmap of the longer phrase, and its popcount the number of occurrences, overlaps included; a shift never passes a
gap. Shards work depth-first, some first words at a time, so only the bitmaps along the way are held. Popcounts are summed over shards.

A shard first sends the hashes and counts of its pairs and triples, packed by bucket; a bucket sums those of all shards and tells each shard
which of its own reach the bar (chance collisions let more through, never fewer). Then a shard extends only these
and gives their words, so all further counts are exact. A phrase is in a shard once, so the most frequent one costs an
entry a shard.

Defined results: null and empty texts have no words; a null lang is `und`; the doc_id isn't read, so rows without one, and repeated
rows, count as often as they come; equal scores are ordered by count and then by the phrase's UTF-8 bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, Block, blocks, byte_class, discard, give_back, lean, materialise, mix, runs, span_hashes, table

LEAST, MOST_WORDS, COVERED, TOP = 10, 3, 50, 2000
NO_LANG = "und"
#: Text of one shard, and text that a task holds for all its languages.
SHARD_BYTES, HELD_BYTES = 8 << 20, 16 << 20
#: Words of the corpus for each bucket of phrases, and shards whose phrases are summed together.
BUCKET_WORDS, GROUP_SHARDS = 2 << 20, 1 << 16
#: Positions of a bitmap's block, and pairs of blocks that are compared at once.
BLOCK, STEP = 16, 1 << 21

#: What parts pieces, and what parts words within them.
BREAKS = ~byte_class((0x2C, 0x2C), (0x2E, 0x2E), (0x3B, 0x3B), (0x3A, 0x3A), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D))
WORDS = ~BREAKS & byte_class((0x20, 0x20), (0x09, 0x09))

SHARD = "shard long, lang string, n_words long, vocabulary binary, sizes binary, at binary, bits binary"
#: Parts of the second window: the first of each lang's rows is found in them before one window ranks what is left.
PARTS = 64


class Bitmaps:
    """Position bitmaps of a shard's words: rows (word, block, bits), sorted by word and block."""

    def __init__(self, vocabulary: list[bytes], word: np.ndarray, block: np.ndarray, bits: np.ndarray):
        self.vocabulary, self.word, self.block, self.bits = vocabulary, word, block, bits

    @staticmethod
    def of(texts: list[Block]) -> Bitmaps:
        """The bitmaps of the words of some texts; positions go on from block to block."""
        hashes, gaps, places = [], [], []
        for k, block in enumerate(texts):
            low = LOWER[block.buf]
            s, e = runs(WORDS[low])
            if not len(s):
                continue
            cut = np.concatenate(([0], np.cumsum(BREAKS[low], dtype=np.int32)))
            gaps.append(np.concatenate(([1], cut[s[1:]] != cut[e[:-1]])).astype(np.int64))
            hashes.append(span_hashes(block.buf, s, e))
            places.append(np.stack((np.full(len(s), k), s, e)))
        if not hashes:
            none = np.zeros(0, np.int64)
            return Bitmaps([], none, none, none.astype(np.uint32))
        position = np.cumsum(1 + np.concatenate(gaps))
        _, first, word = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        where = np.concatenate(places, axis=1)[:, first]
        vocabulary = [texts[k].buf[s:e].tobytes().lower() for k, s, e in where.T.tolist()]
        span = int(position[-1]) // BLOCK + 2
        key = word * span + position // BLOCK
        order = np.argsort(key, kind="stable")
        key, start = np.unique(key[order], return_index=True)
        bits = np.bitwise_or.reduceat((1 << (position % BLOCK)).astype(np.uint32)[order], start)
        return Bitmaps(vocabulary, key // span, key % span, bits)

    def row(self) -> tuple:
        """n_words, vocabulary, sizes, at and bits of SHARD."""
        pack = zstandard.ZstdCompressor(1).compress
        sizes = np.bincount(self.word, minlength=len(self.vocabulary)).astype(np.int32)
        steps = np.diff(self.block, prepend=0).astype(np.int32)
        return int(np.bitwise_count(self.bits).sum(dtype=np.int64)), pack(b" ".join(self.vocabulary)), pack(sizes.tobytes()), pack(steps.tobytes()), pack(self.bits.astype(np.uint16).tobytes())

    @staticmethod
    def read(vocabulary: bytes, sizes: bytes, at: bytes, bits: bytes) -> Bitmaps:
        unpack = zstandard.ZstdDecompressor().decompress
        size = np.frombuffer(unpack(sizes), np.int32)
        block = np.cumsum(np.frombuffer(unpack(at), np.int32), dtype=np.int64)
        return Bitmaps(unpack(vocabulary).split(b" ") if len(size) else [], np.repeat(np.arange(len(size)), size), block, np.frombuffer(unpack(bits), np.uint16).astype(np.uint32))

    def counts(self) -> np.ndarray:
        return np.bincount(self.word, np.bitwise_count(self.bits), len(self.vocabulary)).astype(np.int64)

    def hashes(self) -> np.ndarray:
        joined = np.frombuffer(b" ".join(self.vocabulary) or b" ", np.uint8)
        size = np.array([len(w) for w in self.vocabulary], np.int64)
        end = np.cumsum(size + 1) - 1
        return span_hashes(joined, end - size, end) if len(size) else np.zeros(0, np.uint64)


def _moved(rows: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps shifted by one position; what leaves a block goes into the next."""
    bits = bits << np.uint32(1)
    own, over = bits & np.uint32((1 << BLOCK) - 1), bits >> np.uint32(BLOCK)
    a, b = np.flatnonzero(own), np.flatnonzero(over)
    return np.concatenate((rows[a], rows[b])), np.concatenate((block[a], block[b] + 1)), np.concatenate((own[a], over[b]))


def _met(left: np.ndarray, lbits: np.ndarray, lo: np.ndarray, hi: np.ndarray, rbits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right row, bits) of all left rows and the right rows lo:hi of each whose AND isn't empty, STEP pairs at a time."""
    n = np.cumsum(hi - lo)
    i = 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(n, (n[i - 1] if i else 0) + STEP, side="right")))
        size = (hi - lo)[i:j]
        own = np.repeat(np.arange(i, j), size)
        right = np.arange(len(own)) + np.repeat(lo[i:j] - (np.cumsum(size) - size), size)
        both = lbits[own] & rbits[right]
        some = np.flatnonzero(both)
        yield left[own[some]], right[some], both[some]
        i = j


def extended(maps: Bitmaps) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bitmaps (first word, second word, block, bits) of pairs, some first words at a time; bits are where the second word is."""
    order = np.argsort(maps.block, kind="stable")
    word, block, bits = maps.word[order], maps.block[order], maps.bits[order]
    begins = np.searchsorted(block, np.arange(int(block.max(initial=0)) + 3))
    i, n = 0, len(maps.word)
    while i < n:
        j = i + STEP // 8  # to the end of a word
        j = int(np.searchsorted(maps.word, maps.word[j], side="right")) if j < n else n
        first, at, moved = _moved(maps.word[i:j], maps.block[i:j], maps.bits[i:j])
        found = [(a, word[r], block[r], both) for a, r, both in _met(first, moved, begins[at], begins[at + 1], bits)]
        yield tuple(np.concatenate(x) for x in zip(*found))
        i = j


def longer(first: np.ndarray, second: np.ndarray, block: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(first, second, third word, bits) of the triples that pairs' bitmaps make, some first words at a time: a shifted pair meets the pairs that begin with its second word."""
    if not len(first):
        return
    span = int(block.max()) + 2
    order = np.argsort(first * span + block, kind="stable")
    first, second, block, bits = first[order], second[order], block[order], bits[order]
    key, begins = np.unique(first * span + block, return_index=True)
    begins = np.append(begins, len(first))
    i = 0
    while i < len(first):
        j = i + STEP // 8
        j = int(np.searchsorted(first, first[j], side="right")) if j < len(first) else len(first)
        rows, at, moved = _moved(np.arange(i, j), block[i:j], bits[i:j])
        probe = second[rows] * span + at
        near = np.argsort(probe)  # in order they are found much faster
        rows, moved, probe = rows[near], moved[near], probe[near]
        found = np.minimum(np.searchsorted(key, probe), len(key) - 1)
        hit = np.flatnonzero(key[found] == probe)
        rows, moved, found = rows[hit], moved[hit], found[hit]
        for left, right, both in _met(rows, moved, begins[found], begins[found + 1], bits):
            yield first[left], second[left], second[right], both
        i = j


def _popcounts(key: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how many bits each has, and each row's place among them."""
    key, place = np.unique(key, return_inverse=True)
    return key, np.bincount(place, np.bitwise_count(bits), len(key)).astype(np.int64), place


class Hashes:
    """64-bit hashes of a shard's phrases, made word by word, and what of them is sent: a bucket, and 32 bits besides. Buckets grow with the corpus, so
    the bits that tell phrases apart do, too."""

    def __init__(self, maps: Bitmaps, lang: str, buckets: int):
        self.word, self.buckets = maps.hashes() ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())), np.uint64(buckets)

    def of(self, *phrase: np.ndarray) -> np.ndarray:
        h = self.word[phrase[0]]
        for w in phrase[1:]:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + self.word[w])
        return ((h >> np.uint64(32)) * self.buckets & ~np.uint64(0xFFFFFFFF)) | (h & np.uint64(0xFFFFFFFF))


def codes(maps: Bitmaps, lang: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, popcount) of a shard's pairs and triples, in the order of their codes."""
    v, hashed = len(maps.vocabulary), Hashes(maps, lang, buckets)
    code, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    pairs = []
    for a, b, block, bits in extended(maps):
        pairs.append((a, b, block, bits))
        key, count, _ = _popcounts(a * v + b, bits)
        code.append(hashed.of(key // v, key % v))
        n.append(count)
    if pairs:
        for a, b, c, bits in longer(*(np.concatenate(x) for x in zip(*pairs))):
            two, at = np.unique(a * v + b, return_inverse=True)
            key, count, _ = _popcounts(at * v + c, bits)
            two = two[key // v]
            code.append(hashed.of(two // v, two % v, key % v))
            n.append(count)
    return _summed(np.concatenate(code), np.concatenate(n))


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, place = np.unique(code, return_inverse=True)
    return code, np.bincount(place, n, len(code)).astype(np.int64)


def _among(x: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    if not len(allowed):
        return np.zeros(len(x), bool)
    return allowed[np.minimum(np.searchsorted(allowed, x), len(allowed) - 1)] == x


def phrase_counts(maps: Bitmaps, lang: str, allowed: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(words..., popcount) of the pairs whose codes are allowed, and of the triples that they make and that are allowed."""
    v, hashed = len(maps.vocabulary), Hashes(maps, lang, buckets)
    allowed = np.sort(allowed)
    kept = []
    for a, b, block, bits in extended(maps):
        key, n, place = _popcounts(a * v + b, bits)
        good = _among(hashed.of(key // v, key % v), allowed)
        yield key[good] // v, key[good] % v, n[good]
        stay = good[place]
        kept.append((a[stay], b[stay], block[stay], bits[stay]))
    if kept:
        for a, b, c, bits in longer(*(np.concatenate(x) for x in zip(*kept))):
            two, at = np.unique(a * v + b, return_inverse=True)
            key, n, _ = _popcounts(at * v + c, bits)
            a, b, c = two[key // v] // v, two[key // v] % v, key % v
            good = _among(hashed.of(a, b, c), allowed)
            yield a[good], b[good], c[good], n[good]


# --- in Spark --------------------------------------------------------------------------------


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHARD rows from (lang, text)."""
    held: dict[str, list[Block]] = {}
    sizes: dict[str, int] = {}
    n = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    names = [x.split()[0] for x in SHARD.split(", ")]

    def flush(lang: str) -> pa.RecordBatch:
        nonlocal n
        n += 1
        row = n, lang, *Bitmaps.of(held.pop(lang)).row()
        sizes.pop(lang)
        give_back()
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)

    for batch in batches:
        lang = batch.column("lang").to_pylist()
        for own in dict.fromkeys(lang):
            rows = batch.filter(pa.array([x == own for x in lang]))
            for block in blocks([rows], key="lang"):
                held.setdefault(own, []).append(block)
                sizes[own] = sizes.get(own, 0) + len(block.buf)
                if sizes[own] >= SHARD_BYTES:
                    yield flush(own)
                elif sum(sizes.values()) >= HELD_BYTES:
                    yield flush(max(sizes, key=sizes.get))
    for own in list(held):
        yield flush(own)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, str, Bitmaps, int]]:
    for i in range(len(batch)):
        row = {c: batch.column(c)[i].as_py() for c in ("shard", "lang", "vocabulary", "sizes", "at", "bits")}
        yield row["shard"], row["lang"], Bitmaps.read(*(row[c] for c in ("vocabulary", "sizes", "at", "bits"))), i


def _asking(buckets: int, least: int):
    """A shard's pairs and triples, a row a bucket; counts are of no interest beyond the bar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, maps, _ in _read(batch):
                code, n = codes(maps, lang, buckets)
                bucket, key, n = code >> np.uint64(32), code.astype(np.uint32), np.minimum(n, least).astype(np.uint16)
                cut = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets))) if len(code) else np.zeros(0, np.int64)
                ends = [*cut.tolist()[1:], len(code)]
                cols = (bucket[cut].astype(np.int64), np.full(len(cut), shard), [key[i:j].tobytes() for i, j in zip(cut, ends)], [n[i:j].tobytes() for i, j in zip(cut, ends)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "shard", "keys", "counts"])
                give_back()

    return run


def _together(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts of a bucket's rows, summed."""
    keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.uint32)
    return _summed(keys, np.frombuffer(b"".join(part.column("counts").to_pylist()), np.uint16).astype(np.int64))


def _merging(least: int):
    """A bucket's rows of one group as one row."""

    def run(part: pa.Table) -> pa.Table:
        key, n = _together(part)
        return pa.table({"bucket": part.column("bucket").slice(0, 1), "keys": [key.tobytes()], "counts": [np.minimum(n, least).astype(np.uint16).tobytes()]})

    return run


def _often(least: int):
    """The keys of a bucket that reach the bar."""

    def run(part: pa.Table) -> pa.Table:
        key, n = _together(part)
        return pa.table({"bucket": part.column("bucket").slice(0, 1), "often": [key[n >= least].tobytes()]})

    return run


def _answers(asked: pa.Table, often: np.ndarray) -> pa.Table:
    """(shard, bucket, keys): what of a shard's own keys reaches the bar."""
    own = [np.frombuffer(k, np.uint32) for k in asked.column("keys").to_pylist()]
    hit = np.isin(np.concatenate(own), often, assume_unique=False)
    cut = np.cumsum([0, *map(len, own)])
    kept = [k[hit[a:b]].tobytes() for k, a, b in zip(own, cut, cut[1:])]
    out = pa.table({"shard": asked.column("shard"), "bucket": asked.column("bucket"), "keys": pa.array(kept, pa.binary())})
    return out.filter(pa.array([len(k) > 0 for k in kept]))


def _frequent(shards: DataFrame, least: int, buckets: int, groups: int) -> DataFrame:
    """(shard, told array<struct<bucket, keys>>): the codes of each shard's pairs and triples that occur `least` times over all shards.

    A bucket of all shards is settled in one task; of very many shards, in groups whose sums are added up first.
    """
    sent = shards.mapInArrow(lean(_asking(buckets, least)), "bucket long, shard long, keys binary, counts binary")
    told = "shard long, bucket long, keys binary"
    if groups == 1:

        def settle(part: pa.Table) -> pa.Table:
            key, n = _together(part)
            return _answers(part, key[n >= least])

        answers = sent.groupBy("bucket").applyInArrow(settle, told)
    else:
        sent = materialise(sent.withColumn("grp", F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("long")))
        sums = sent.groupBy("bucket", "grp").applyInArrow(_merging(least), "bucket long, keys binary, counts binary")
        often = sums.groupBy("bucket").applyInArrow(_often(least), "bucket long, often binary").withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

        def answer(asked: pa.Table, told_: pa.Table) -> pa.Table:
            if not len(asked):
                return asked.select(["shard", "bucket", "keys"])
            return _answers(asked, np.frombuffer(told_.column("often")[0].as_py(), np.uint32))

        answers = sent.groupBy("bucket", "grp").cogroup(often.groupBy("bucket", "grp")).applyInArrow(answer, told)
    return answers.groupBy("shard").agg(F.collect_list(F.struct("bucket", "keys")).alias("told"))


def _counting(buckets: int):
    """(lang, phrase, f) of a shard's words and of its frequent phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lang, maps, i in _read(batch):
                text = pa.array(maps.vocabulary, pa.binary()).cast(pa.string(), safe=False)
                told = batch.column("told")[i].as_py() or []
                allowed = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(t["keys"], np.uint32) | np.uint64(t["bucket"] << 32) for t in told)])
                for *phrase, n in [(np.arange(len(text)), maps.counts()), *phrase_counts(maps, lang, allowed, buckets)]:
                    for at in range(0, len(n), 100_000):
                        words = [text.take(pa.array(x[at : at + 100_000], pa.int64())) for x in phrase]
                        joined = pc.binary_join_element_wise(*words, " ") if len(words) > 1 else words[0]
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(joined), pa.string()), joined, pa.array(n[at : at + 100_000], pa.int64())], ["lang", "phrase", "f"])
                give_back()

    return run


def _score(a: str, l: str, r: str) -> Column:
    """floor(1000000 a a / (l r)) in exact decimals: products of counts below 10**15 have at most 37 digits."""
    a, l, r = (F.col(x).cast("decimal(15,0)") for x in (a, l, r))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r)


def mined(docs: DataFrame, least: int = LEAST, bucket_words: int = BUCKET_WORDS, group_shards: int = GROUP_SHARDS) -> DataFrame:
    """(lang, phrase, f) of all words, and of all phrases of two and three words with f of at least `least`; a written table."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shards = materialise(own.mapInArrow(lean(_sharded), SHARD))
    words, n = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.count("*")).first()
    buckets, groups = max(1, -(-words // bucket_words)), max(1, -(-n // group_shards))
    maps = shards.select("shard", "lang", "vocabulary", "sizes", "at", "bits")
    answers = _frequent(maps, least, buckets, groups)
    joined = maps.join(answers.withColumnRenamed("shard", "__of"), F.col("shard") == F.col("__of"), "left")
    each = joined.select(*maps.columns, "told").mapInArrow(lean(_counting(buckets)), "lang string, phrase string, f long")
    out = materialise(each.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(~F.contains("phrase", F.lit(" ")) | (F.col("f") >= least)))
    discard(shards)
    return out


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each lang."""
    f = mined(docs, least).withColumn("w", F.split("phrase", " "))
    of = lambda k: f.where(F.size("w") == k).select("lang", *[F.get("w", F.lit(i)).alias(f"w{i + 1}") for i in range(k)], "f")
    word, pair, triple = of(1).toDF("wl", "w", "fw"), of(2), of(3)
    total = word.groupBy("wl").agg(F.sum("fw").alias("n"))

    def with_count(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(word, (F.col("lang") == F.col("wl")) & (F.col(column) == F.col("w"))).drop("wl", "w").withColumnRenamed("fw", name)

    def with_pair(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
        p = pair.select(F.col("lang").alias("pl"), F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("f").alias(name))
        return df.join(p, (F.col("lang") == F.col("pl")) & (F.col(first) == F.col("p1")) & (F.col(second) == F.col("p2"))).drop("pl", "p1", "p2")

    # a phrase of three words has no longer candidate; a pair goes if one that holds it is frequent enough
    inside = triple.select("lang", "f", F.explode(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")), F.struct(F.col("w2").alias("x"), F.col("w3").alias("y")))).alias("p"))
    inside = inside.groupBy(F.col("lang").alias("il"), F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.max("f").alias("longer"))
    free = pair.join(inside, (F.col("lang") == F.col("il")) & (F.col("w1") == F.col("x")) & (F.col("w2") == F.col("y")), "left")
    free = free.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f"))).select("lang", "w1", "w2", F.col("f").alias("a"))
    two = with_count(with_count(free, "w1", "l"), "w2", "r").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = with_pair(with_pair(triple.withColumnRenamed("f", "a"), "w1", "w2", "l2"), "w2", "w3", "r1")
    three = with_count(with_count(three, "w1", "l1"), "w3", "r2").withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    later = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(later, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    rows = two.unionByName(three).withColumn("part", part)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.join(total, F.col("lang") == F.col("wl")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE_SQL = f"""
with p as (
  select coalesce(lang, '{NO_LANG}') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) piece from documents
), q as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') w from p
), o as (
  select lang, w, unnest(range(1, len(w) + 1)) i from q
), g as (
  select lang, x, count(*) f from (select lang, unnest([w[i:i], case when i < len(w) then w[i:i + 1] end, case when i + 1 < len(w) then w[i:i + 2] end]) x from o) where x is not null group by lang, x
), n as (
  select lang, sum(f)::bigint n from g where len(x) = 1 group by lang
), candidate as (
  select lang, x, f a from g where len(x) > 1 and f >= {LEAST}
), cut as (
  select c.lang, c.x, a, k, l.f l, r.f r, (1000000::hugeint * a * a // (l.f::hugeint * r.f))::bigint score
  from (select *, unnest(range(1, len(x))) k from candidate) c join g l on l.lang = c.lang and l.x = c.x[1:k] join g r on r.lang = c.lang and r.x = c.x[k + 1:len(c.x)]
), lowest as (
  select *, row_number() over (partition by lang, x order by score, k) pos from cut
), covered as (
  select distinct s.lang, s.x from candidate s join (select lang, a, unnest([x[1:2], x[2:3]]) x from candidate where len(x) = 3) t on t.lang = s.lang and t.x = s.x where 100 * t.a >= {COVERED} * s.a
), ranked as (
  select lang, array_to_string(x, ' ') phrase, a, l, r, score, row_number() over (partition by lang order by score desc, a desc, array_to_string(x, ' ')) rank
  from lowest where pos = 1 and (lang, x) not in (select lang, x from covered)
)
select lang, rank::bigint rank, phrase, a::bigint a, l::bigint l, r::bigint r, n, score from ranked join n using (lang) where rank <= {TOP}
"""
