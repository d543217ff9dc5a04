"""LM scoring by online logistic context mixing.

A text is its words in lower case, each followed by a space, and an end mark. A token is coded by binary decisions:

* does it go on as three words did elsewhere (then by their counts), as two did (then by theirs), does it repeat a word of this text;
* else its first two bytes are spelled in bits, by a Huffman code of bytes; then, is it a word of the training documents
  (by its share of those that begin so), or new, and spelled to its end in bits.

Every bit and every decision is predicted from several hashed contexts: bits from the bits before, the topic (the commonest short
word so far), the beginning of the word before, and for the rest of a new word its last bytes; decisions from how often the words before
occurred together, what came true just before, and the word before. The predictions are mixed in the logistic domain by weights that a gate
selects, and refined by an adaptive table. A decision that foretells a word weighs its counts against all that follows, so
probabilities add up to one at most. The weights of decisions go on learning while a text is coded: after each CHUNK words every
document adds what it has learned to its own weights, so a score doesn't depend on other texts coded beside it.

What is gathered from the corpus grows with it: exact counts of all words, pairs and triples of words of all training documents (by
hashes of their bytes; of pairs and triples as many bits as keep chance matches under one in a million). A training document is scored by the
counts of the others: its own are taken off, so it is judged as a held-out one is, and what another document says too stands out. (The
base model's counts are whole.) Bit counts of the contexts of spelling lie in tables of fixed size that may be broadcast at
any input size. Weights, refinement and the counts of decisions are learned from all training documents too: each shard predicts its own with
a first model and sends sums (counts, refinement, slopes and curvatures of the weights), by which all weights take one Newton step. The
first model, from which that step starts, comes from one pass over FIT_DOCS training documents with the smallest hashes of doc_id, of at
most FIT_BYTES together. Everything is learned from training documents alone, in sums that don't depend on partitions.

The corpus is written once as compressed shards in the shared folder. A shard sends each of its words, pairs and triples once to
the bucket of its hash and gets the sum back; empty buckets get no row, so a shard sends at most a row an entry.

Defined results: null or empty text is the end mark alone; rows whose doc_id is null are left out; repeated rows count as often
as they come; without training documents all counts are 0.
"""

from __future__ import annotations

import pickle
import struct
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SPACED, blocks, materialise, mix, runs, span_hashes, table

HELD_OUT = 1
#: Text of a shard; text of a bucket of counts; tables that one task sums.
SHARD_BYTES, BUCKET_BYTES, FAN_IN = 3 << 20, 8 << 20, 64
#: Shards whose counts one task sums; more are summed in groups of so many first.
GROUP = 1 << 16
#: Documents that the first model is fitted on, and bytes of one and of all of them, at most.
FIT_DOCS, FIT_BYTES = 1024, 4 << 20
#: Words after which a document's own weights learn.
CHUNK = 64
#: Bits of a pair's or triple's hash beyond log2 of the number of words.
SPARE = 20
#: Tables of bit counts, log2 of their slots: first bytes after nothing, a topic, the first bytes of the word before; the rest of a word after
#: its last bytes; and how many training tokens begin with each two bytes.
SLOTS = (17, 18, 20, 16, 19, 20, 16)
LEAD, REST, LEAVES = (0, 1, 2), (3, 4, 5), 6
#: Bytes before a bit that the contexts of a word's rest hold.
LAST = (2, 3, 5)
#: Words from which the topic is taken, and the bytes of a short word.
TOPIC, SHORT = (16, 128), 4
#: Slots of a part of a table that is summed by itself.
PART = 1 << 18
DELTA, CELLS = 0.05, 33
RATE, OWN_RATE, BLOCK = 0.05, 0.02, 2048
#: Tokens that a shard predicts at once for its sums; what holds weights back in the step of all (spelling tables hold the tokens that are
#: predicted, so few texts must not move much), and the most that one moves.
PREDICTED, RIDGE, STRIDE = 1 << 16, 1e5, 0.5
BLOCK_BITS = 1 << 18
END_LEAF = 10 << 8
END_HASH, START_HASH = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


# --- shards ----------------------------------------------------------------------------------

SHARD = "shard long, n int, ids binary, ends binary, text binary, bytes array<long>"


def _is_held(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == HELD_OUT


def _shards(sample: bool = False):
    """Documents side by side, compressed; the sample is one shard with the number -1, of the first FIT_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SHARD.split(", ")]
        number = -1 if sample else (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

        def write(window: list) -> pa.RecordBatch:
            ids = np.concatenate([np.array(b.ids, np.int64) for b in window])
            text = b"".join(b.buf.tobytes() + b"\n\n" for b in window)
            base = np.cumsum([0] + [len(b.buf) + 2 for b in window])
            ends = np.concatenate([b.ends + o for b, o in zip(window, base)])
            hist = np.zeros(256, np.int64)  # of the training documents alone
            for b in window:
                low = LOWER[b.buf]
                for k, i in enumerate(b.ids):
                    if not _is_held(i):
                        hist += np.bincount(low[b.starts[k] : b.ends[k]], minlength=256)
            cols = [[number], [len(ids)], [ids.tobytes()], [ends.tobytes()], [zstandard.compress(text, 3)], [hist.tolist()]]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        window, size = [], 0
        for block in blocks(batches, 1 << 16 if sample else 1 << 20, sep=b"\n\n"):
            if sample and size + len(block.buf) > FIT_BYTES:
                break
            window.append(block)
            size += len(block.buf)
            if size >= SHARD_BYTES and not sample:
                yield write(window)
                window, size, number = [], 0, number + 1
        if window:
            yield write(window)

    return run


def _order(keys: np.ndarray) -> np.ndarray:
    """Places by rising key, equal keys in their order: keys and places are sorted as one number. Where both don't fit, the
    lowest bits of the keys don't count."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    low, bits = keys.min(), max(1, (n - 1).bit_length())
    cut = max(0, (int(keys.max()) - int(low)).bit_length() + bits - 64)
    packed = ((keys - low).astype(np.uint64) >> np.uint64(cut) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values about in order, the number of each element's value, and a first place of each value.

    Two values that differ in their lowest bits only may come mixed, and then more than once; sums over buckets don't mind.
    """
    order = _order(hashes)
    s = hashes[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    number = np.empty(len(s), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return s[new], number, order[new]


class Shard:
    """A shard's tokens in the documents' order: hashes, places, first bytes; and its distinct words, pairs and triples."""

    def __init__(self, ids: bytes, ends: bytes, text: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        end = np.frombuffer(ends, np.int64)
        self.buf = buf = LOWER[np.frombuffer(zstandard.decompress(text), np.uint8)]
        s, e = runs(SPACED[buf])
        docs = len(end)
        n = np.diff(np.concatenate(([0], np.searchsorted(s, end))))
        self.bounds = np.concatenate(([0], np.cumsum(n + 1)))
        at = np.arange(len(s)) + np.repeat(np.arange(docs), n)  # an end mark after each document's words
        total = len(s) + docs
        self.doc = np.repeat(np.arange(docs, dtype=np.int32), n + 1)
        self.place = np.arange(total, dtype=np.int32) - self.bounds[self.doc].astype(np.int32)
        self.token = np.full(total, END_HASH, np.uint64)
        self.token[at] = span_hashes(buf, s, e, lower=False)
        self.start, self.size = np.zeros(total, np.int32), np.zeros(total, np.int32)
        self.start[at], self.size[at] = s, e - s
        # the end mark is a newline; a word of one byte is followed by its space
        self.leaf = np.full(total, END_LEAF, np.int64)
        self.leaf[at] = buf[s].astype(np.int64) << 8 | np.where(e - s > 1, buf[np.minimum(s + 1, len(buf) - 1)], 32)
        self.held = np.array([_is_held(i) for i in self.ids.tolist()], bool) if docs else np.zeros(0, bool)
        self.train = ~self.held[self.doc]
        self.prev = self._shift(self.token, START_HASH)
        pair = mix(self.prev * _A + self.token)
        triple = mix((self._shift(pair, START_HASH) ^ _B) * _A + self.token)
        self.grams = [_distinct(self.token), _distinct(pair), _distinct(triple)]

    def _shift(self, x: np.ndarray, none) -> np.ndarray:
        """What the token before has; `none` at a document's start."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.bounds[:-1]] = none
        return out

    def counts(self, kind: int) -> np.ndarray:
        """Training occurrences of each distinct word, pair or triple."""
        return np.bincount(self.grams[kind][1][self.train], minlength=len(self.grams[kind][0]))

    def own(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each token's word, pair or triple: how often it occurs in the document, and did before."""
        _, number, _ = self.grams[kind]
        key = self.doc.astype(np.int64) * (int(number.max(initial=0)) + 1) + number
        order = _order(key)
        k = key[order]
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(k)))
        n, before = np.empty(len(k), np.int32), np.empty(len(k), np.int32)
        n[order] = np.repeat(size, size)
        before[order] = np.arange(len(k)) - np.repeat(first, size)
        return n, before

    def topics(self) -> np.ndarray:
        """The hash of the commonest short word among a document's first words, for the tokens after them."""
        out = np.zeros(len(self.token), np.uint64)
        _, number, _ = self.grams[0]
        for words in TOPIC:
            some = np.flatnonzero((self.place < words) & (self.size > 0) & (self.size <= SHORT))
            if not len(some):
                continue
            key = self.doc[some].astype(np.int64) << 32 | number[some]
            pair, n = np.unique(key, return_counts=True)
            doc = pair >> 32
            by = np.lexsort((pair, -n, doc))
            head = by[np.flatnonzero(np.diff(doc[by], prepend=-1))]
            of = np.zeros(len(self.ids), np.uint64)
            of[doc[head]] = self.grams[0][0][pair[head] & 0xFFFFFFFF]
            late = self.place >= words
            out[late] = of[self.doc[late]]
        return out


# --- bits and contexts -----------------------------------------------------------------------


class Code:
    """A Huffman code of bytes: node and bit of each step, padded."""

    def __init__(self, hist: list[int]):
        heap = [(n + 1, b, b) for b, n in enumerate(hist)]  # every byte has a code
        heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        node = 256
        while len(heap) > 1:
            a, b = heappop(heap), heappop(heap)
            children[node] = (a[2], b[2])
            heappush(heap, (a[0] + b[0], node, node))
            node += 1
        paths: dict[int, list[tuple[int, int]]] = {}
        stack = [(heap[0][2], [])]
        while stack:
            x, path = stack.pop()
            if x < 256:
                paths[x] = path
            else:
                for bit, child in enumerate(children[x]):
                    stack.append((child, [*path, (x - 256, bit)]))
        most = max(map(len, paths.values()))
        self.length = np.array([len(paths[b]) for b in range(256)])
        self.node = np.zeros((256, most), np.int64)
        self.bit = np.zeros((256, most), bool)
        for b, path in paths.items():
            self.node[b, : len(path)] = [x for x, _ in path]
            self.bit[b, : len(path)] = [x for _, x in path]

    def steps(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the bits of some bytes: which byte, node and bit."""
        length = self.length[symbol]
        of = np.repeat(np.arange(len(symbol)), length)
        step = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length)
        symbol = symbol[of]
        return of, self.node[symbol, step], self.bit[symbol, step]


def _slot(context: np.ndarray, node: np.ndarray, table_: int) -> np.ndarray:
    return (((context ^ ((node.astype(np.uint64) + np.uint64(1)) * _B)) * _A) >> np.uint64(64 - SLOTS[table_])).astype(np.int64)


def lead_bits(code: Code, leaf: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The bits of some beginnings (two bytes; of the end mark one): which, gate, bit, and a slot for each context, LEAD[-n:] of n."""
    two = np.stack((leaf >> 8, np.where(leaf == END_LEAF, -1, leaf & 255)), axis=1).ravel()
    own = np.flatnonzero(two >= 0)
    of, node, bit = code.steps(two[own])
    which, later = own[of] >> 1, (own[of] & 1).astype(bool)
    whole = np.where(later, 256 + 256 * (leaf[which] >> 8) + node, node)
    slots = [whole if k == 0 else _slot(c[which], whole, k) for k, c in zip(LEAD[-len(contexts) :], contexts)]
    return which, node + 256 * later, bit, slots


def rest_bytes(shard: Shard, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes from the third of some words to the space behind them: which word, the word's last bytes before, and the byte."""
    start, size = shard.start[tokens].astype(np.int64), shard.size[tokens].astype(np.int64)
    n = np.where(size > 1, size - 1, 0)
    word = np.repeat(np.arange(len(tokens)), n)
    begin = np.repeat(start, n)
    at = begin + 2 + np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    symbol = np.where(at < begin + np.repeat(size, n), shard.buf[np.minimum(at, len(shard.buf) - 1)], 32).astype(np.int64)
    last = np.zeros(len(at), np.uint64)
    for j in range(max(LAST)):
        place = at - 1 - j
        last |= np.where(place >= begin, shard.buf[np.maximum(place, 0)], 0).astype(np.uint64) << np.uint64(8 * j)
    return word, last, symbol


def _recent(last: np.ndarray, n: int) -> np.ndarray:
    return last & np.uint64((1 << 8 * n) - 1)


def _pieces(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of about `limit` in size."""
    done, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + limit, side="right")))
        yield slice(at, to)
        at = to


class Tables:
    """Bit counts of the contexts' slots, and how many training tokens begin with each two bytes."""

    def __init__(self):
        self.n = [np.zeros((2, 1 << s), np.int64) for s in SLOTS]

    def learn(self, shard: Shard, code: Code) -> None:
        """Beginnings of all training tokens; the rest of each distinct training word once: it is for words that have no count."""
        leaf = shard.leaf[shard.train]
        self.n[LEAVES][0] += np.bincount(leaf, minlength=1 << 16)
        topics, topic = np.unique(shard.topics()[shard.train], return_inverse=True)
        before = shard._shift(shard.leaf, 0)[shard.train]
        for table_, context, names in ((1, topic, topics), (2, before, None)):
            pair, n = np.unique(context.astype(np.int64) << 16 | leaf, return_counts=True)
            c = (pair >> 16).astype(np.uint64) if names is None else names[pair >> 16]
            for j in _pieces(np.full(len(pair), 9), BLOCK_BITS):
                which, _, bit, slots = lead_bits(code, pair[j] & 0xFFFF, [c[j]] * (3 - table_))
                self._add(table_, bit, slots[0], n[j][which])
        words = shard.grams[0][2][shard.counts(0) > 0]
        for j in _pieces(shard.size[words] + 1, BLOCK_BITS):
            _, last, symbol = rest_bytes(shard, words[j])
            for table_, bytes_ in zip(REST, LAST):
                pair, n = np.unique(_recent(last, bytes_) << np.uint64(8) | symbol.astype(np.uint64), return_counts=True)
                of, node, bit = code.steps((pair & np.uint64(255)).astype(np.int64))
                self._add(table_, bit, _slot((pair >> np.uint64(8))[of], node, table_), n[of])

    def _add(self, table_: int, bit: np.ndarray, slot: np.ndarray, n: np.ndarray) -> None:
        np.add.at(self.n[table_].reshape(-1), slot + (bit.astype(np.int64) << SLOTS[table_]), n)

    def stretch(self, code: Code) -> list[np.ndarray]:
        """What each slot says of a one; the table without a context follows from the beginnings."""
        leaf = np.flatnonzero(self.n[LEAVES][0])
        which, _, bit, slots = lead_bits(code, leaf, [leaf.astype(np.uint64)] * 3)
        self.n[0][:] = 0
        self._add(0, bit, slots[0], self.n[LEAVES][0][leaf][which])
        return [np.log((n[1] + DELTA) / (n[0] + DELTA)).astype(np.float16) for n in self.n[:LEAVES]]


# --- mixing ----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Mixer:
    """Weights of the inputs for each gate, and the refining table."""

    def __init__(self, gates: int, inputs: int):
        self.weights = np.full((gates, inputs), 1.2 / inputs, np.float32)
        self.sums = np.full((gates, inputs), 1.0)
        self.hits = self.unseen(gates)

    @staticmethod
    def unseen(gates: int) -> np.ndarray:
        """A refining table that is drawn to each cell's middle where little was seen."""
        middle = _sigmoid((np.arange(gates * CELLS) % CELLS - CELLS // 2) / 2)
        return np.stack((8 * (1 - middle), 8 * middle))

    def dot(self, gate: np.ndarray, inputs: list[np.ndarray], own: np.ndarray | None = None) -> np.ndarray:
        total = np.zeros(len(gate), np.float32)
        for k, x in enumerate(inputs):
            total += (self.weights[gate, k] if own is None else self.weights[gate, k] + own[:, k]) * x
        return np.clip(total, -15, 15, out=total)

    def refined(self, gate: np.ndarray, dot: np.ndarray) -> np.ndarray:
        """Probability of a one."""
        c = self._cell(gate, dot)
        return 0.5 * _sigmoid(dot) + 0.5 * (self.hits[1][c] / (self.hits[0][c] + self.hits[1][c]))

    def learn(self, gate: np.ndarray, inputs: list[np.ndarray], dot: np.ndarray, target: np.ndarray, n: np.ndarray | None = None) -> None:
        """A step down the block's cost, then the refining table; the target is a bit or how much a decision had to do with what came."""
        error = target - _sigmoid(dot)
        for k, x in enumerate(inputs):
            grad = np.bincount(gate, error * x, len(self.weights))
            self.sums[:, k] += grad**2
            self.weights[:, k] += (RATE * grad / np.sqrt(self.sums[:, k])).astype(np.float32)
        c = self._cell(gate, dot)
        self.hits[1] += np.bincount(c, target, self.hits.shape[1])
        self.hits[0] += np.bincount(c, 1.0 - target, self.hits.shape[1])

    @staticmethod
    def _cell(gate: np.ndarray, dot: np.ndarray) -> np.ndarray:
        return gate * CELLS + np.clip(np.rint(dot * 2) + CELLS // 2, 0, CELLS - 1).astype(np.int64)


class Summed(Mixer):
    """A mixer that predicts as another one does and only sums what it would learn."""

    def __init__(self, first: Mixer):
        gates, k = first.weights.shape
        self.weights, self.hits = first.weights, first.hits
        self.slope, self.curve, self.seen = np.zeros((gates, k)), np.zeros((gates, k, k)), np.zeros(first.hits.shape)

    def learn(self, gate: np.ndarray, inputs: list[np.ndarray], dot: np.ndarray, target: np.ndarray, n: np.ndarray | None = None) -> None:
        p, times = _sigmoid(dot.astype(np.float64)), np.ones(len(gate)) if n is None else n.astype(np.float64)
        error, bend = (target - p) * times, p * (1 - p) * times
        x = [v.astype(np.float64) for v in inputs]
        for k in range(len(x)):
            self.slope[:, k] += np.bincount(gate, error * x[k], len(self.weights))
            bent = bend * x[k]
            for j in range(k + 1):
                self.curve[:, k, j] += np.bincount(gate, bent * x[j], len(self.weights))
        c = self._cell(gate, dot)
        self.seen[1] += np.bincount(c, target * times, self.seen.shape[1])
        self.seen[0] += np.bincount(c, (1.0 - target) * times, self.seen.shape[1])

    def step(self, mixer: Mixer) -> None:
        """The mixer's weights after one Newton step, and its refining table, from these sums alone."""
        curve = self.curve + np.tril(self.curve, -1).swapaxes(1, 2)  # the lower half was summed
        move = np.linalg.solve(curve + RIDGE * np.eye(curve.shape[1]), self.slope[:, :, None])[:, :, 0]
        mixer.weights = (mixer.weights + np.clip(move, -STRIDE, STRIDE)).astype(np.float32)
        mixer.hits = self.unseen(len(mixer.weights)) + self.seen


class Own:
    """What each document adds to the weights while it is coded."""

    def __init__(self, docs: int, inputs: int):
        self.delta, self.sums = np.zeros((docs, inputs), np.float32), np.full((docs, inputs), 1.0)

    def learn(self, doc: np.ndarray, inputs: list[np.ndarray], dot: np.ndarray, target: np.ndarray) -> None:
        error = target - _sigmoid(dot)
        low = int(doc.min(initial=0))
        for k, x in enumerate(inputs):
            grad = np.bincount(doc - low, error * x)
            j = slice(low, low + len(grad))
            self.sums[j, k] += grad**2
            self.delta[j, k] += (OWN_RATE * grad / np.sqrt(self.sums[j, k])).astype(np.float32)


#: Decisions: contexts' sizes, and gates.
DECISIONS = {"three": ((256, 512, 4096), 16), "two": ((256, 512, 4096), 16), "again": ((256, 16, 4096), 16), "known": ((16, 1 << 16), 16)}


#: Those that foretell words, from the last to the first.
TOLD = ("again", "two", "three")


class Decider:
    """A decision: counts of its contexts, and the mixer of their predictions."""

    def __init__(self, sizes: tuple, gates: int):
        self.n = [np.zeros((2, s)) for s in sizes]
        self.mixer = Mixer(gates, len(sizes))
        self.stretch: list[np.ndarray] | None = None

    def settle(self) -> None:
        self.stretch = [np.log((n[1] + 0.2) / (n[0] + 0.2)).astype(np.float32) for n in self.n]

    def inputs(self, contexts: list[np.ndarray]) -> list[np.ndarray]:
        if self.stretch is not None:
            return [s[c] for s, c in zip(self.stretch, contexts)]
        return [np.log((n[1][c] + 0.2) / (n[0][c] + 0.2)).astype(np.float32) for n, c in zip(self.n, contexts)]

    def add(self, contexts: list[np.ndarray], target: np.ndarray) -> None:
        for n, c in zip(self.n, contexts):
            n[1] += np.bincount(c, target, n.shape[1])
            n[0] += np.bincount(c, 1.0 - target, n.shape[1])


# --- what a document is told -----------------------------------------------------------------


def _log2(x: np.ndarray, most: int) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(x, 1)).astype(np.int64), most)


class Told:
    """The tokens of a shard with all that the counts say of them; counts of a document's own are taken off."""

    def __init__(self, shard: Shard, totals: list[np.ndarray], leaves: np.ndarray):
        self.shard, self.topic, self.before = shard, shard.topics(), shard._shift(shard.leaf, 0)
        doc, place = shard.doc, shard.place
        self.whole = totals[0][shard.grams[0][1]]
        left, earlier = [], None
        for kind in range(3):
            own, before = shard.own(kind)
            left.append(np.maximum(totals[kind][shard.grams[kind][1]] - np.where(shard.train, own, 0), 0))
            if kind == 0:
                earlier = before
        one, two, three = left
        beyond = leaves[shard.leaf]
        self.known = one > 0
        self.share = np.minimum(one / np.maximum(beyond, 1), 1.0)
        after_one, after_two = shard._shift(one, 0), np.where(place > 0, shard._shift(two, 0), 0)
        self.foretold = {
            "three": np.minimum(three / np.maximum(after_two, 1), 1.0),
            "two": np.minimum(two / np.maximum(after_one, 1), 1.0),
            "again": earlier / np.maximum(place, 1),
        }
        self.asked = {"three": after_two > 0, "two": (after_one > 0) & (place > 0), "again": place > 0, "known": np.ones(len(doc), bool)}
        self.foretold = {k: np.where(self.asked[k], v, 0.0) for k, v in self.foretold.items()}
        came = {k: self._came(v > 0) for k, v in self.foretold.items()}
        came["known"] = self._came(~self.known)
        run = self._run(self.foretold["three"] > 0)
        word = (shard.prev >> np.uint64(52)).astype(np.int64)
        often2, often3, far = _log2(after_one, 15), _log2(after_two, 15), _log2(place, 15)
        self.contexts = {
            "three": [often3 * 16 + came["three"], np.minimum(run, 31) * 16 + often3, word],
            "two": [often2 * 16 + came["three"], often2 * 16 + came["two"] + 256, word],
            "again": [far * 16 + came["again"], came["again"], word],
            "known": [came["known"], shard.leaf],
        }
        self.gate = {"three": came["three"], "two": often2, "again": came["again"], "known": came["known"]}

    def _came(self, hit: np.ndarray) -> np.ndarray:
        """What came true at the four tokens before, as bits."""
        out, x = np.zeros(len(hit), np.int64), hit.astype(np.int64)
        for k in range(4):
            x = self.shard._shift(x, 0)
            out |= x << k
        return out

    def _run(self, hit: np.ndarray) -> np.ndarray:
        """How many tokens before this one came true without a miss."""
        at = np.arange(len(hit))
        last = np.maximum.accumulate(np.where(hit, -1, at)) if len(hit) else at
        start = self.shard.bounds[self.shard.doc]
        before = np.concatenate(([-1], last[:-1])) if len(hit) else at
        return np.where(self.shard.place > 0, at - 1 - np.maximum(before, start - 1), 0)


class Model:
    """Everything that scores texts."""

    def __init__(self, code: Code, stretch: list[np.ndarray], leaves: np.ndarray):
        self.code, self.stretch, self.leaves = code, stretch, leaves
        self.lead, self.rest = Mixer(512, len(LEAD)), Mixer(256, len(REST))
        self.deciders = {k: Decider(*v) for k, v in DECISIONS.items()}

    def lead_cost(self, leaf: np.ndarray, topic: np.ndarray, before: np.ndarray, learn: bool = False, n: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of beginnings, each after a topic and another beginning."""
        which, gate, bit, slots = lead_bits(self.code, leaf, [topic, topic, before.astype(np.uint64)])
        return self._spelled(self.lead, LEAD, len(leaf), which, gate, bit, slots, learn, None if n is None else n[which])

    def rest_cost(self, told: Told, tokens: np.ndarray, learn: bool = False) -> np.ndarray:
        """log10 probability of the rest of new words."""
        word, last, symbol = rest_bytes(told.shard, tokens)
        of, node, bit = self.code.steps(symbol)
        slots = [_slot(_recent(last, n)[of], node, k) for k, n in zip(REST, LAST)]
        return self._spelled(self.rest, REST, len(tokens), word[of], node, bit, slots, learn)

    def _spelled(self, mixer: Mixer, tables: tuple, n: int, of: np.ndarray, gate: np.ndarray, bit: np.ndarray, slots: list[np.ndarray], learn: bool, times: np.ndarray | None = None) -> np.ndarray:
        inputs = [self.stretch[k][x].astype(np.float32) for k, x in zip(tables, slots)]
        dot = mixer.dot(gate, inputs)
        p = mixer.refined(gate, dot)
        if learn:
            mixer.learn(gate, inputs, dot, bit.astype(np.float64), times)
        return np.bincount(of, np.log10(np.maximum(np.where(bit, p, 1 - p), 1e-9)), n)

    def all_leads(self, told: Told, learn: bool = False) -> np.ndarray:
        """lead_cost() of every token: once for each distinct beginning, topic and beginning before; learned from as often as in training."""
        leaf, before = told.shard.leaf, told.before
        topics, topic = np.unique(told.topic, return_inverse=True)
        key = (topic.astype(np.int64) << 32) | (before << 16) | leaf
        order = _order(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        some = order[new]
        n = np.bincount(np.cumsum(new) - 1, told.shard.train[order], len(some)) if learn else None
        cost = np.concatenate([self.lead_cost(leaf[some[j]], told.topic[some[j]], before[some[j]], learn, n[j] if learn else None) for j in _pieces(np.full(len(some), 9), BLOCK_BITS)] or [np.zeros(0)])
        out = np.empty(len(key))
        out[order] = cost[np.cumsum(new) - 1]
        return out

    def decide(self, name: str, told: Told, tokens: np.ndarray, rest: np.ndarray, own: Own | None = None, learn: bool = False) -> np.ndarray:
        """log10 probability of each token, from that of all that comes after this decision."""
        ask = told.asked[name][tokens]
        some = tokens[ask]
        if not len(some):
            return rest
        d, contexts, gate = self.deciders[name], [c[some] for c in told.contexts[name]], told.gate[name][some]
        inputs, doc = d.inputs(contexts), told.shard.doc[some]
        dot = d.mixer.dot(gate, inputs, None if own is None else own.delta[doc])
        p = np.clip(d.mixer.refined(gate, dot), 1e-6, 1 - 1e-6)
        out = rest.copy()
        if name == "known":
            known = told.known[some]
            target = known.astype(np.float64)
            out[ask] += np.log10(np.where(known, p * np.maximum(told.share[some], 1e-300), 1 - p))
        else:
            of = p * told.foretold[name][some]
            other = (1 - p) * 10 ** np.maximum(rest[ask], -290)
            target = of / (of + other)
            out[ask] = np.where(of > 0, np.log10(of + other), np.log10(1 - p) + rest[ask])
        if learn:
            d.mixer.learn(gate, inputs, dot, target)
            d.add(contexts, target)
        elif own is not None:
            own.learn(doc, inputs, dot, target)
        return out

    def fit(self, told: Told) -> None:
        """One pass over a sample, block by block; each block is predicted before it is learned from."""
        n = len(told.topic)
        for at in range(0, n, BLOCK):
            tokens = np.arange(at, min(at + BLOCK, n))
            out = self.lead_cost(told.shard.leaf[tokens], told.topic[tokens], told.before[tokens], learn=True)
            out = self.decide("known", told, tokens, out, learn=True)
            new = np.flatnonzero(~told.known[tokens] & (told.shard.size[tokens] > 1))
            if len(new):
                out[new] += self.rest_cost(told, tokens[new], learn=True)
            for name in TOLD:
                out = self.decide(name, told, tokens, out, learn=True)
        for d in self.deciders.values():
            d.settle()

    def summing(self) -> Model:
        """This model, for sums(): what it learns is counted apart."""
        out = Model(self.code, self.stretch, self.leaves)
        out.lead, out.rest = Summed(self.lead), Summed(self.rest)
        for k, d in out.deciders.items():
            d.mixer, d.stretch = Summed(self.deciders[k].mixer), self.deciders[k].stretch
        return out

    def counted(self) -> list[np.ndarray]:
        """All that a summing model counts."""
        mixers = [self.lead, self.rest, *(d.mixer for d in self.deciders.values())]
        return [x for m in mixers for x in (m.slope, m.curve, m.seen)] + [n for d in self.deciders.values() for n in d.n]

    def sums(self, told: Told) -> np.ndarray:
        """What all training tokens of a shard say of the model, as one row of numbers to be added to those of other shards."""
        model = self.summing()
        cost = model.all_leads(told, learn=True)
        train = np.flatnonzero(told.shard.train)
        for at in range(0, len(train), PREDICTED):
            tokens = train[at : at + PREDICTED]
            out = model.decide("known", told, tokens, cost[tokens], learn=True)
            new = np.flatnonzero(~told.known[tokens] & (told.shard.size[tokens] > 1))
            if len(new):
                out[new] += model.rest_cost(told, tokens[new], learn=True)
            for name in TOLD:
                out = model.decide(name, told, tokens, out, learn=True)
        return np.concatenate([x.ravel() for x in model.counted()])

    def step(self, sums: np.ndarray) -> None:
        """The weights, refinement and decisions that the sums of all shards give."""
        model, at = self.summing(), 0
        for x in model.counted():
            x[...] = sums[at : at + x.size].reshape(x.shape)
            at += x.size
        model.lead.step(self.lead)
        model.rest.step(self.rest)
        for k, d in self.deciders.items():
            model.deciders[k].mixer.step(d.mixer)
            d.n = model.deciders[k].n
            d.settle()

    def score(self, told: Told) -> np.ndarray:
        """log10 probability of each token; documents are coded side by side, chunk by chunk, each with its own weights."""
        own = {k: Own(len(told.shard.ids), len(v[0])) for k, v in DECISIONS.items()}
        out = self.all_leads(told)
        new = np.flatnonzero(~told.known & (told.shard.size > 1))
        rest = np.zeros(len(out))
        for j in _pieces(told.shard.size[new] * 5, BLOCK_BITS):
            rest[new[j]] = self.rest_cost(told, new[j])
        chunk = told.shard.place // CHUNK
        order = _order(chunk)
        cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            tokens = order[a:b]
            cost = self.decide("known", told, tokens, out[tokens], own["known"]) + rest[tokens]
            for name in TOLD:
                cost = self.decide(name, told, tokens, cost, own[name])
            out[tokens] = cost
        return out


# --- tasks -----------------------------------------------------------------------------------

GATHERED = "kind int, key long, shard long, blob binary"
GRAMS, TABLE, TOTALS = range(3)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all low bytes first: what is small compresses."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _numbers(raw: bytes, kind, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T).reshape(-1).view(kind)


def _gather(code: Code, buckets: int, shift: int):
    def asks(shard: Shard, number: int) -> Iterator[tuple]:
        """A row for each bucket that has anything of the shard; bucket b holds the b-th of equal parts of the hashes."""
        bucket = [((g[0] >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24) for g in shard.grams]
        some = np.unique(np.concatenate(bucket))
        first, last = ([np.searchsorted(b, some, side) for b in bucket] for side in ("left", "right"))
        counts = [shard.counts(k) if number >= 0 else np.zeros(len(shard.grams[k][0]), np.int64) for k in range(3)]
        keys = [g[0] >> np.uint64(shift if k else 0) for k, g in enumerate(shard.grams)]
        for i, b in enumerate(some.tolist()):
            at = [slice(first[k][i], last[k][i]) for k in range(3)]
            parts = [struct.pack("<3q", *(j.stop - j.start for j in at))]
            for k, j in enumerate(at):
                parts += [_planes(np.diff(keys[k][j], prepend=np.uint64(0))), _planes(counts[k][j].astype(np.uint64))]
            yield GRAMS, b, number, zstandard.compress(b"".join(parts), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, any_ = Tables(), False
        for batch in batches:
            for i in range(len(batch)):
                number, _, *blobs = (batch.column(k)[i].as_py() for k in range(5))
                shard = Shard(*blobs)
                yield _rows(list(asks(shard, number)))
                if number >= 0:
                    tables.learn(shard, code)
                    any_ = True
        if any_:
            for k, n in enumerate(tables.n):
                for part in range(0, n.shape[1], PART):
                    yield _rows([(TABLE, (k << 40) | part, number, zstandard.compress(_planes(n[:, part : part + PART].ravel()), 1))])

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [(), (), (), ()]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [x.split()[0] for x in GATHERED.split(", ")])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in GATHERED.split(", ")])


def _added(part: pd.DataFrame, of=np.int64) -> pd.DataFrame:
    """One sum of some tables."""
    total = 0
    for r in map(zstandard.decompress, part["blob"]):
        total = total + _numbers(r, of, len(r) // 8, 0)
    kind, key, shard = (int(part[c].iloc[0]) for c in ("kind", "key", "shard"))
    return _frame([(kind, key, shard, zstandard.compress(_planes(total), 1))])


def _tree(rows: DataFrame, n: int, of=np.int64) -> DataFrame:
    """One sum a (kind, key) of at most n rows each, FAN_IN or so at a time, in as many levels as that takes."""
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        rows = rows.groupBy("kind", "key", F.pmod(F.xxhash64("shard"), F.lit(n))).applyInPandas(lambda part: _added(part, of), GATHERED)
    return rows.groupBy("kind", "key").applyInPandas(lambda part: _added(part, of), GATHERED)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets' totals of words, summed in the task."""
    sums = np.zeros(2, np.int64)
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            sums += np.frombuffer(blob, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(sums[:1]), pa.array(sums[1:])], ["words", "distinct"])


def _asked(blobs: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """For words, pairs and triples: the distinct ones, which of them each entry is, the entries' counts, and how many entries each blob has."""
    raw = list(map(zstandard.decompress, blobs))
    sizes, at = [struct.unpack_from("<3q", r) for r in raw], [24] * len(raw)
    for k in range(3):
        keys, counts = [], []
        for i, r in enumerate(raw):
            n = sizes[i][k]
            keys.append(np.cumsum(_numbers(r, np.uint64, n, at[i]), dtype=np.uint64))
            counts.append(_numbers(r, np.uint64, n, at[i] + 8 * n).astype(np.int64))
            at[i] += 16 * n
        distinct, of, _ = _distinct(np.concatenate(keys))
        yield distinct, of, np.concatenate(counts), [x[k] for x in sizes]


def _sum(part: pd.DataFrame) -> pd.DataFrame:
    """The sums of a bucket go back to all that asked, with the bucket's totals of words."""
    answers: list[list[bytes]] = [[] for _ in range(len(part))]
    key, totals, every = int(part["key"].iloc[0]), None, []
    for distinct, of, counts, sizes in _asked(part["blob"]):
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, of, counts)
        if totals is None:
            totals = np.array([int(total.sum()), int((total > 0).sum())]).tobytes()
        done = 0
        for i, n in enumerate(sizes):
            answers[i].append(_planes(total[of[done : done + n]]))
            done += n
        every.append(sizes)
    out = [(TOTALS, key, -1, totals)]
    out += [(GRAMS, key, int(s), zstandard.compress(struct.pack("<3q", *n) + b"".join(a), 1)) for s, a, n in zip(part["shard"], answers, zip(*every))]
    return _frame(out)


def _partial(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """What a group of shards asks for, as one shard would: each word, pair and triple once, with the group's count."""
    parts, sizes = [], []
    for distinct, of, counts, _ in _asked(part["blob"]):
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, of, counts)
        parts += [_planes(np.diff(distinct, prepend=np.uint64(0))), _planes(total.astype(np.uint64))]
        sizes.append(len(distinct))
    return _frame([(GRAMS, int(key[0]), int(key[1]), zstandard.compress(struct.pack("<3q", *sizes) + b"".join(parts), 1))])


def _spread(asks: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
    """A group's answer, dealt to its shards; its entries are in the order in which _partial() asked."""
    if not len(asks):
        return _frame([])
    raw, at = zstandard.decompress(answer["blob"].iloc[0]), 24
    each: list[list[bytes]] = [[] for _ in range(len(asks))]
    every = []
    for distinct, of, _, sizes in _asked(asks["blob"]):
        total = _numbers(raw, np.int64, len(distinct), at)
        at, done = at + 8 * len(distinct), 0
        for i, n in enumerate(sizes):
            each[i].append(_planes(total[of[done : done + n]]))
            done += n
        every.append(sizes)
    key = int(asks["key"].iloc[0])
    return _frame([(GRAMS, key, int(s), zstandard.compress(struct.pack("<3q", *n) + b"".join(a), 1)) for s, a, n in zip(asks["shard"], each, zip(*every))])


def _answers(gathered: DataFrame, shards: int, group: int) -> DataFrame:
    """Sums of tables, answers to shards and totals of buckets, as one written table. With more than `group` shards a very common word
    has an entry for each group, not for each shard, in the task that sums it."""
    salt = F.pmod(F.xxhash64("shard"), F.lit(max(1, -(-shards // FAN_IN))))
    groups = -(-shards // group)
    if groups > 1:
        gathered = materialise(gathered)
    tables = gathered.where(F.col("kind") == TABLE).groupBy("kind", "key", salt).applyInPandas(lambda part: _added(part), GATHERED)
    asks = gathered.where(F.col("kind") == GRAMS)
    if groups == 1:
        # one pass over what is gathered: tables and counts are told apart in the task
        keyed = gathered.withColumn("salt", F.when(F.col("kind") == TABLE, salt).otherwise(0))
        return materialise(keyed.groupBy("kind", "key", "salt").applyInPandas(lambda part: _added(part) if part["kind"].iloc[0] == TABLE else _sum(part), GATHERED))
    asks = asks.withColumn("grp", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    partial = asks.groupBy("key", "grp").applyInPandas(lambda key, part: _partial(key, part), GATHERED)
    sums = materialise(partial.groupBy("key").applyInPandas(lambda part: _sum(part), GATHERED))
    dealt = asks.groupBy("key", "grp").cogroup(sums.where(F.col("kind") == GRAMS).groupBy("key", "shard")).applyInPandas(lambda a, b: _spread(a, b), GATHERED)
    return materialise(tables.union(dealt).union(sums.where(F.col("kind") == TOTALS)))


def _told(row, answers: pd.DataFrame, leaves: np.ndarray) -> Told:
    """A shard with its answers, which are in the order of its questions."""
    shard = Shard(row.ids, row.ends, row.text)
    totals: list[list[np.ndarray]] = [[], [], []]
    for _, blob in sorted(zip(answers["key"], answers["blob"])):
        raw, at = zstandard.decompress(blob), 24
        for k, n in enumerate(struct.unpack_from("<3q", raw)):
            totals[k].append(_numbers(raw, np.int64, n, at))
            at += 8 * n
    return Told(shard, [np.concatenate(t) if t else np.zeros(0, np.int64) for t in totals], leaves)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"


def _score(sent, total: int, distinct: int):
    def run(shards: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        model, out = sent.value, []
        for row in shards.itertuples(index=False):
            told = _told(row, answers, model.leaves)
            shard, n = told.shard, len(told.shard.ids)
            base = np.log10((told.whole + 0.5) / (total + 0.5 * (distinct + 1)))
            cost = model.score(told)
            out.append(pd.DataFrame({
                "doc_id": shard.ids, "held_out": shard.held, "n_tokens": np.diff(shard.bounds), "n_known": np.bincount(shard.doc, told.whole > 0, n).astype(np.int64),
                "train_tokens": np.full(n, total), "base_score": np.bincount(shard.doc, base, n), "score": np.bincount(shard.doc, cost, n),
                "n_bytes": np.bincount(shard.doc, shard.size + 1, n).astype(np.int64),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[x.split()[0] for x in SCORED.split(", ")])

    return run


def _fit(sent):
    def run(shards: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        model, out = sent.value, []
        for row in shards.itertuples(index=False):
            model.fit(_told(row, answers, model.leaves))
            out.append(pickle.dumps((model.lead, model.rest, model.deciders)))
        return pd.DataFrame({"blob": out})

    return run


def _learn(sent):
    def run(shards: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        model, out = sent.value, []
        for row in shards.itertuples(index=False):
            out.append((TABLE, 0, int(row.shard), zstandard.compress(_planes(model.sums(_told(row, answers, model.leaves))), 1)))
        return _frame(out)

    return run


def score(docs: DataFrame) -> DataFrame:
    """SCORED for each document: the base model's and the mixing model's log10 probability; bits per byte are -score / log10(2) / n_bytes."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    trains = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != HELD_OUT
    some = own.where(trains & (F.coalesce(F.octet_length("text"), F.lit(0)) <= 1 << 16))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(FIT_DOCS).coalesce(1)
    shards = materialise(own.mapInArrow(_shards(), SHARD).unionByName(some.mapInArrow(_shards(True), SHARD)))
    hist = {r[0]: r[1] for r in shards.where("shard >= 0").select(F.posexplode("bytes")).groupBy("pos").agg(F.sum("col")).collect()}
    code = Code([hist.get(b, 0) for b in range(256)])
    size = shards.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    text = 3 * (size[0] or 0)  # compressed to about a third
    buckets = max(8, -(-text // BUCKET_BYTES))
    shift = max(0, 64 - SPARE - max(1, text // 6).bit_length())
    gathered = shards.mapInArrow(_gather(code, buckets, shift), GATHERED)
    # tables of many tasks are summed in levels, so no task takes more than FAN_IN of them
    summed = _answers(gathered, size[1], GROUP)
    tables = Tables()
    for row in _tree(summed.where(F.col("kind") == TABLE), -(-size[1] // FAN_IN)).toLocalIterator():  # of a fixed size, whatever the corpus
        raw, k, at = zstandard.decompress(row["blob"]), row["key"] >> 40, row["key"] & ((1 << 40) - 1)
        n = _numbers(raw, np.int64, len(raw) // 8, 0).reshape(2, -1)
        tables.n[k][:, at : at + n.shape[1]] = n
    totals = summed.where(F.col("kind") == TOTALS).select("blob").mapInArrow(_totals, "words long, distinct long")
    total, distinct = totals.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    model = Model(code, tables.stretch(code), tables.n[LEAVES][0])
    del tables
    answers = summed.where(F.col("kind") == GRAMS).select("shard", "key", "blob")
    columns = shards.select("shard", "ids", "ends", "text")

    def beside(part: str, function, schema: str) -> DataFrame:
        return columns.where(part).groupBy("shard").cogroup(answers.where(part).groupBy("shard")).applyInPandas(function, schema)

    first = spark.sparkContext.broadcast(model)
    for row in beside("shard < 0", _fit(first), "blob binary").collect():  # one row of a fixed size
        model.lead, model.rest, model.deciders = pickle.loads(row["blob"])
    first.destroy()
    for d in model.deciders.values():
        d.settle()
    second = spark.sparkContext.broadcast(model)
    for row in _tree(beside("shard >= 0", _learn(second), GATHERED), size[1], np.float64).collect():  # one row, or none without training documents
        raw = zstandard.decompress(row["blob"])
        model.step(_numbers(raw, np.float64, len(raw) // 8, 0))
    second.destroy()
    return beside("shard >= 0", _score(spark.sparkContext.broadcast(model), total, distinct), SCORED)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
