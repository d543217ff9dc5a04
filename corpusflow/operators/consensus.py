"""Several transcripts of a clip: agreement, early consensus and token voting.

candidates: (filepath, model, text).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import percent
from ..functions.text import consensus_key, is_missing, normalize_transcript


def digest(text: Column) -> Column:
    """128 bits that stand for a text, made where it is read."""
    return F.unhex(F.md5(F.encode(text, "utf-8")))


def agreed(candidates: DataFrame, k: int, key: str = "filepath") -> DataFrame:
    """(key) of clips for which k transcripts or more are the same. k < 1: none."""
    if k < 1:
        return candidates.select(key).limit(0)
    same = candidates.where(~is_missing(F.col("text"))).groupBy(key, digest(consensus_key(F.col("text"))).alias("t")).agg(F.count("*").alias("n"))
    return same.where(F.col("n") >= k).select(key).distinct()


def without_consensus(work: DataFrame, candidates: DataFrame, k: int, key: str = "filepath") -> DataFrame:
    """work that still needs another transcript."""
    done = agreed(candidates, k, key).withColumnRenamed(key, "__done")
    return work.join(done, work[key] == F.col("__done"), "left_anti")


def agreement(columns: Sequence[str]) -> Column:
    """Share of the other transcripts that agree with the most common one, in percent; null for fewer than two.

    A column expression over the model columns: no shuffle.
    """
    if len(columns) < 2:
        return F.lit(None).cast("double")
    texts = F.filter(F.array(*[normalize_transcript(F.col(f"`{c}`")) for c in columns]), lambda t: t != "")

    def share(x: Column) -> Column:
        most = F.array_max(F.transform(x, lambda t: F.size(F.filter(x, lambda u: u == t))))
        return F.when(F.size(x) >= 2, percent(most - 1, F.size(x) - 1))

    # the texts are a lambda's variable, so each is normalised once and not wherever it is named
    return F.get(F.transform(F.array(texts), share), F.lit(0))


def agreement_of(candidates: DataFrame, key: str = "filepath") -> DataFrame:
    """(key, asr_consistency_percent) from the long table; of the texts only digests are sent."""
    said = candidates.select(key, normalize_transcript(F.col("text")).alias("t")).where("t <> ''")
    n = said.groupBy(key, digest(F.col("t")).alias("t")).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.when(F.sum("n") >= 2, percent(F.max("n") - 1, F.sum("n") - 1)).alias("asr_consistency_percent"))


# --- token voting ----------------------------------------------------------------------------

Slots = list[list[str | None]]


class _Band:
    """Least edits of slots against words along a band of diagonals: rows of costs, a few of which are kept, so memory
    grows with the band times the root of the words. cost(i, j) is exact where it is no more than the band's reach."""

    def __init__(self, slots: np.ndarray, words: np.ndarray, low: int, high: int):
        self.slots, self.low, self.width = slots, low, high - low + 1
        self.m, self.gone = len(words), np.where((slots == NONE).any(axis=1), 0, 1) if len(slots) else np.zeros(0, np.int64)
        self.words = np.concatenate((np.full(self.width + len(slots) + 1, OUT), words, np.full(self.width + len(slots) + 1, OUT)))
        self.pad = self.width + len(slots) + 1
        self.step = max(1, int(len(slots) ** 0.5))
        self.at = np.arange(self.width)
        self.kept = {0: self._inserted(np.where(self.at + low == 0, 0, FAR), 0)}
        row = self.kept[0]
        for i in range(1, len(slots) + 1):
            row = self._next(row, i)[0]
            if i % self.step == 0 or i == len(slots):
                self.kept[i] = row
        self.total = int(row[self.m - len(slots) - low]) if 0 <= self.m - len(slots) - low < self.width else FAR

    def _inserted(self, base: np.ndarray, i: int) -> np.ndarray:
        row = np.minimum.accumulate(base - self.at) + self.at
        j = self.at + i + self.low
        return np.where((j < 0) | (j > self.m), FAR, row)

    def _next(self, row: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row i of the costs from the one before, and the costs by way of a word in the slot and of none."""
        w = self.words[self.pad + i + self.low - 1 :][: self.width]
        miss = np.ones(self.width, np.int64)
        for s in self.slots[i - 1]:
            miss &= w != s
        over = row + miss
        over[w == OUT] = FAR
        up = np.append(row[1:], FAR) + self.gone[i - 1]
        return self._inserted(np.minimum(over, up), i), over, up

    def path(self) -> Iterator[str]:
        """The edits from the end: a word of the slot before none, none before a word of its own."""
        i, o = len(self.slots), self.m - len(self.slots) - self.low
        block: dict[int, np.ndarray] = {}
        while i or o + i + self.low:
            if i not in block:  # the rows since the last one kept
                block, at = {}, ((i - 1) // self.step) * self.step if i else 0
                row = self.kept[at]
                if i == 0:
                    block[0] = np.full(self.width, INSERT, np.int8)
                for k in range(at + 1, i + 1):
                    row, over, up = self._next(row, k)
                    block[k] = np.where(row == over, MATCH, np.where(row == up, SKIP, INSERT)).astype(np.int8)
            move = block[i][o]
            yield move
            if move == MATCH:
                i -= 1
            elif move == SKIP:
                i, o = i - 1, o + 1
            else:
                o -= 1


NONE, OUT, FAR = -1, -2, 1 << 40
MATCH, SKIP, INSERT = 0, 1, 2


def align(slots: Slots, words: list[str], seen: int) -> Slots:
    """Slots of `seen` transcripts with one more, by least edits; None is a missing word.

    Only a band of diagonals is computed, four times as wide until the edits fit into it, so nearly equal texts
    of any length cost little.
    """
    tail: Slots = []
    n, m = len(slots), len(words)
    while n and m and None not in slots[n - 1] and words[m - 1] in slots[n - 1]:  # an equal end is matched by any least edits
        tail.append([*slots[n - 1], words[m - 1]])
        n, m = n - 1, m - 1
    number: dict[str | None, int] = {None: NONE}
    ids = np.array([[number.setdefault(w, len(number)) for w in s] for s in slots[:n]], np.int64).reshape(n, seen)
    own = np.array([number.setdefault(w, len(number)) for w in words[:m]], np.int64)
    reach = 16
    while True:
        band = _Band(ids, own, -(reach + max(n - m, 0)), max(reach, m - n))
        if band.total <= reach or reach >= n + m:
            break
        reach *= 4
    out, i, j = tail, n, m
    for move in band.path():
        if move == MATCH:
            out.append([*slots[i - 1], words[j - 1]])
            i, j = i - 1, j - 1
        elif move == SKIP:
            out.append([*slots[i - 1], None])
            i -= 1
        else:
            out.append([*[None] * seen, words[j - 1]])
            j -= 1
    return out[::-1]


def vote(transcripts: Sequence[str], tokenizer: Callable[[str], list[str]], detokenizer: Callable[[list[str]], str]) -> str:
    """The words that most transcripts have in each slot; of equals a word before none, then the earliest transcript's.

    Of three transcripts at most, two that are equal win as they are: the later one fits into the slots without an edit, so each slot
    has its word twice, or none twice. The same holds where all are equal. Only others are aligned.
    """
    said = [tokenizer(t) for t in transcripts]
    for i, words in enumerate(said):
        if words in said[i + 1 :] and len(said) <= 3 or said.count(words) == len(said):
            return detokenizer(words)
    return detokenizer(_voted(said))


def _voted(said: Sequence[list[str]]) -> list[str]:
    slots: Slots = []
    for seen, words in enumerate(said):
        slots = align(slots, words, seen) if seen else [[w] for w in words]
    out = []
    for slot in slots:
        best = max(dict.fromkeys(slot), key=lambda w: (slot.count(w), w is not None, -slot.index(w)))
        if best is not None:
            out.append(best)
    return out


def rover(candidates: DataFrame, key: str = "filepath", tokenizer: Callable[[str], list[str]] = lambda t: t.lower().split(), detokenizer: Callable[[list[str]], str] = " ".join) -> DataFrame:
    """(key, text, error): one voted transcript a clip.

    Alignment is an order-dependent dynamic programme over words, which no built-in expression has, so each clip's few
    transcripts go to Python, where sorted clips stream by; a clip that fails gives its error and doesn't stop the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, rows = None, None, []  # the clip, its transcripts, and what the clips before it gave

        def settle() -> None:
            if texts is None:
                return
            try:
                rows.append((now, vote(texts, tokenizer, detokenizer), None))
            except Exception as e:  # noqa: BLE001
                rows.append((now, None, f"{type(e).__name__}: {e}"))

        def given() -> pa.RecordBatch:
            out = list(zip(*rows)) or [()] * 3
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (kind, pa.string(), pa.string()))], [key, "text", "error"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts is None or k != now:
                    settle()
                    now, texts = k, []
                if isinstance(text, str) and text.strip():
                    texts.append(text)
            yield given()
        settle()
        if rows:
            yield given()

    schema = T.StructType([candidates.schema[key], *T.StructType.fromDDL("text string, error string")])
    own = candidates.select(key, "model", "text").repartition(key).sortWithinPartitions(key, F.asc_nulls_last("model"))
    return own.select(key, "text").mapInArrow(run, schema)


def text_candidates(sidecars: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Candidates from sidecars of the given kinds; derived texts are never candidates."""
    own = sidecars.where(F.col("kind").isin(*kinds) & ~F.col("filepath").rlike("_(rover|phonemes|accent)"))
    return own.select("filepath", F.col("kind").alias("model"), "text")
