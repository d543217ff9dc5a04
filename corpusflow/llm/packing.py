"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents are tokenised where they are read; only a small row per piece is shuffled. Packers then take pieces in the
order of the corpus, each once (bounded-space online best fit): a fixed number of open bins is kept in a bitset keyed by free
space; a piece goes into the bin that it fills best, and if too many bins are open the fullest closes first.
Packers work on slices of the corpus of bounded size, dealt by hash, so that the few bins that each leaves
half full do not count.

If the tokenizer's normal form and splitting drop white space and part words (its parts are compared with the known ones), the
ids of a text are those of its parts between spaces and newlines, and the ids of parts seen before are kept in a
bounded cache. The texts of any other tokenizer are encoded whole.

Defined results: null or empty text is the end token alone; rows whose doc_id is null are packed like others;
repeated rows are packed as often as they come.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, keep_cache, lean, materialise, table

CAPACITY = 4096
END = 1
#: Bins that a packer keeps open, at most; a packer fills some four thousand.
OPEN_BINS = 256
#: Parts whose ids a worker keeps, about 270 bytes each, or those of its last block if these are more.
CACHE = 600_000
SEPARATOR, MARKS = "7", ".,"
#: A packer's share: tokens, and pieces.
SHARE_TOKENS, SHARE_PIECES = 16 << 20, 500_000

# The normal form and the splitting for which parts may be encoded alone, and the splitting's pattern.
NORMAL = ["NFC", "Replace", "Lowercase"]
SPLIT = ["Split", "ByteLevel"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_cache: dict[str, bytes] = {}
_tokenizers: dict = {}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long"


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers.clear()
        _cache.clear()
        whole = Tokenizer.from_file(path)
        _tokenizers[path] = whole, _bare(whole) if _parts_alone(whole) else None
    return _tokenizers[path]


def _lowered(text: str) -> str:
    """The tokenizer lowers all letters; where that is the same before its normal form (Latin-1, no special token) it comes first."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _parts_alone(tokenizer) -> bool:
    """Whether the ids of a text are those of its parts between white space, one after another."""
    t = json.loads(tokenizer.to_str())
    normal, split = t["normalizer"] or {}, t["pre_tokenizer"] or {}
    rules, cuts = normal.get("normalizers", []), split.get("pretokenizers", [])
    if [r["type"] for r in rules] != NORMAL or [c["type"] for c in cuts] != SPLIT or t["post_processor"] or t["truncation"] or t["padding"]:
        return False
    bytes_ = {k: cuts[1][k] for k in ("add_prefix_space", "use_regex")}
    pattern = {k: cuts[0][k] for k in ("pattern", "behavior", "invert")}
    spaces = {k: rules[1][k] for k in ("pattern", "content")}
    return (
        spaces == {"pattern": {"Regex": r"\s+"}, "content": " "}
        and pattern == {"pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True}
        and bytes_ == {"add_prefix_space": False, "use_regex": False}
        and t["model"]["type"] == "BPE"
        and all(" " not in a["content"] for a in t["added_tokens"])
    )


def _bare(tokenizer):
    """The tokenizer's model alone, over words that its normal form and its splitting would leave as they are."""
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return bare


def _encoded(parts: list[str], tokenizer, letters: dict[int, str] | None = None) -> list[str]:
    """Put the ids of the parts into the cache, many at a time with a digit between them: each digit is a token of its own,
    so the ids fall apart at it. Gives back the parts for which that failed."""
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    (cut,) = encode([SEPARATOR], add_special_tokens=False)[0].ids
    lots, failed = [parts[i : i + 1024] for i in range(0, len(parts), 1024)], []
    for i in range(0, len(lots), 16):
        some = lots[i : i + 16]
        joined = [f" {SEPARATOR} ".join(lot) for lot in some]
        if letters is not None:
            joined = [t if t.isascii() else " ".join(w.encode().decode("latin-1").translate(letters) for w in t.split(" ")) for t in joined]
        for lot, e in zip(some, encode(joined, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            at = np.flatnonzero(ids == cut)
            if len(at) != len(lot) - 1:
                failed += lot
                continue
            raw = ids.tobytes()
            _cache.update(zip(lot, [raw[a:b] for a, b in zip([0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(raw)])]))
    return failed


def _learn(parts: list[str], tokenizer, bare) -> None:
    """Put the ids of new parts into the cache.

    Most parts are letters with a full stop or comma at most, which the tokenizer parts from them; of those only the letters
    are encoded, by its model alone if they are Latin-1 in lower case. All others go through the whole tokenizer.
    """
    words, tailed, others = set(), [], []
    for p in parts:
        if p.isalpha():
            words.add(p)
        elif p[:-1].isalpha() and p[-1] in MARKS:
            tailed.append(p)
            words.add(p[:-1])
        else:
            others.append(p)
    plain, odd = [], []
    for w in words.difference(_cache):
        (plain if w.isascii() or max(w) <= "\xff" else odd).append(w)
    if any(w != w.lower() for w in plain):
        odd += [w for w in plain if w != w.lower()]
        plain = [w for w in plain if w == w.lower()]
    others += _encoded(plain, bare, _LETTERS) + odd
    alone = [p for p in others if SEPARATOR in p]
    alone += _encoded([p for p in others if SEPARATOR not in p], tokenizer)
    alone += [m for m in MARKS if m not in _cache]
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    for i in range(0, len(alone), 4096):
        _cache.update(zip(alone[i : i + 4096], [np.array(e.ids, "<u4").tobytes() for e in encode(alone[i : i + 4096], add_special_tokens=False)]))
    _cache.update([(p, _cache[p[:-1]] + _cache[p[-1]]) for p in tailed])


def token_ids(texts: list[str], path: str) -> Iterator[bytes]:
    """The ids of each text, little-endian and unsigned, 32 bits each."""
    tokenizer, bare = _tokenizer(path)
    if bare is None:
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        for i in range(0, len(texts), 64):
            for e in encode(texts[i : i + 64], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()
        return
    parts = [_lowered(t).replace("\n", " ").split(" ") for t in texts]
    keep_cache("packing", _cache)
    own = set().union(*parts)
    _learn(list(own.difference(_cache)), tokenizer, bare)
    if len(_cache) > CACHE:  # what this block has stays: common parts are in every block
        kept = {p: _cache[p] for p in own}
        _cache.clear()
        _cache.update(kept)
    for ps in parts:
        yield b"".join(map(_cache.__getitem__, ps))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """PIECES of every document: its ids and the end token, cut only where they are over the capacity."""
    tail = np.array([end], "<u4").tobytes()
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        for block in blocks(batches):
            rows = []
            texts = [block.raw(k).decode(errors="replace") for k in range(len(block.ids))]
            for doc_id, ids in zip(block.ids, token_ids(texts, path)):
                ids += tail
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    rows.append((doc_id, n, at // 4, len(cut) // 4, zlib.crc32(cut), seen))
                    seen += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run, "packing"), PIECES)


class Bins:
    """Open bins in a bitset keyed by free space: bit f is set if an open bin has f left."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.open, self.n, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def put(self, size: int) -> tuple[int, int]:
        """The bin that a piece goes into and its place there."""
        fits = self.bits >> size
        if fits:  # the smallest free space that is enough
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n >= self.limit:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, b = self.capacity, self.made
            self.made += 1
        if left := free - size:
            self.open[left].append(b)
            self.bits |= 1 << left
            self.n += 1
        return b, self.capacity - free

    def _take(self, free: int) -> int:
        b = self.open[free].pop()
        if not self.open[free]:
            self.bits &= ~(1 << free)
        self.n -= 1
        return b


def pack(rows: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """rows (PIECES, of a written table) with sequence_id and offset."""
    total = rows.agg(F.sum("length"), F.count("*")).first()
    packers = max(1, -(-(total[0] or 0) // SHARE_TOKENS), -(-total[1] // SHARE_PIECES))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bins = Bins(capacity, open_bins)
        part = part.sort_values("spread", ignore_index=True)  # as they came
        at = [bins.put(n) for n in part["length"].tolist()]
        part["sequence_id"] = [b * packers + int(key[0]) for b, _ in at]
        part["offset"] = [o for _, o in at]
        return part[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = rows.groupBy(F.pmod(F.xxhash64("spread"), F.lit(packers)).alias("packer"))
    return dealt.applyInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, open_bins: int = OPEN_BINS) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(materialise(pieces(docs, path, capacity, end)), capacity, open_bins)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizer())
