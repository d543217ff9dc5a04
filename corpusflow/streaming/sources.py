"""Sources that come in chunks: a stateful scorer whose queue and cache live between the chunks of a source.

A source's chunks are numbered; they are taken in that order, whatever batch they come in and in whatever order: early ones wait in the state, those that
come again are dropped. The state is typed: the queue of latest frames, the cache of older ones (compressed by operators.cache when it is full),
the mean of silent frames, and the chunks that wait. A call of the state costs more than the frames it moves, so a batch asks for queue and cache only
where a chunk's turn has come, and chunks go into the state only if they wait. It is bounded by the rule's sizes and what waits. A source ends when the stream's event time is
`idle` seconds past its own last chunk: a timer, which is set anew only when it expires, then gives its last row, counts what still waits and clears the state. Event time, not the clock, so a
replay ends sources at the same place.

The scorer is a plug-in: a function of the cache, the queue and the chunk (arrays of frames) that gives the chances of all their frames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.cache import Rule, compress, silence_mean

Score = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]

OUTPUT = "source string, chunk long, frame long, p array<double>, cached int, ended boolean, waiting int"
_FRAMES = "x array<double>, p array<double>"
#: Chunks of a source that a task holds before they go to the state, and up to which waiting ones are read at once.
HELD = 1_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Memory:
    """What a source remembers between two chunks."""

    width: int
    rule: Rule
    queue_size: int
    next: int = 0
    frames: int = 0
    silent: int = 0
    mean: np.ndarray = field(default=None)
    queue: tuple[np.ndarray, np.ndarray] = field(default=None)
    cache: tuple[np.ndarray, np.ndarray] = field(default=None)

    def __post_init__(self):
        none = lambda: (np.zeros((0, self.width)), np.zeros((0, self.rule.speakers)))
        self.queue, self.cache = self.queue or none(), self.cache or none()
        self.mean = np.zeros(self.width) if self.mean is None else self.mean

    def take(self, chunk: np.ndarray, score: Score) -> np.ndarray:
        """The chances of a chunk's frames; queue and cache go on."""
        kept, queued = len(self.cache[0]), len(self.queue[0])
        p = np.asarray(score(self.cache[0], self.queue[0], chunk), float)
        self.queue = np.concatenate((self.queue[0], chunk)), p[kept : kept + queued + len(chunk)]
        over = len(self.queue[0]) - self.queue_size
        if over > 0:
            # whole chunks leave the queue, so that it begins where a chunk did
            out = min(max(len(chunk), over), len(self.queue[0]))
            x, q = self.queue[0][:out], self.queue[1][:out]
            self.queue = self.queue[0][out:], self.queue[1][out:]
            self.mean, self.silent = silence_mean(self.mean, self.silent, x, q)
            self.cache = np.concatenate((self.cache[0], x)), np.concatenate((self.cache[1], q))
            if len(self.cache[0]) > self.rule.size:
                slots = compress(self.cache[1], self.rule)
                full = slots >= 0
                self.cache = np.where(full[:, None], self.cache[0][slots], self.mean), np.where(full[:, None], self.cache[1][slots], 0.0)
        self.next, self.frames = self.next + 1, self.frames + len(chunk)
        return p[kept + queued :]


class Chunks(StatefulProcessor):
    """Scores the chunks of one source, in order."""

    def __init__(self, score: Score, width: int, rule: Rule, queue_size: int, idle: float):
        self.score, self.width, self.rule, self.queue_size, self.idle = score, width, rule, queue_size, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "next long, frames long, silent long, mean array<double>, timer long, last long, waiting long")
        self.queue = handle.getListState("queue", _FRAMES)
        self.cache = handle.getListState("cache", _FRAMES)
        self.early = handle.getMapState("early", "chunk long", "size int, x array<double>")

    def _load(self) -> tuple[Memory, int, int, int]:
        """The source's memory, without the frames of its queue and cache, which only a chunk whose turn it is asks for."""
        head = self.head.get()
        if head is None:
            return Memory(self.width, self.rule, self.queue_size), 0, 0, 0
        n, frames, silent, mean, timer, last, waiting = head
        return Memory(self.width, self.rule, self.queue_size, n, frames, silent, np.array(mean)), timer, last, waiting

    def _frames(self, m: Memory) -> None:
        two = lambda rows, k, w: np.array([r[k] for r in rows], float).reshape(-1, w)
        if m.frames:
            m.queue, m.cache = ((two(r, 0, self.width), two(r, 1, self.rule.speakers)) for r in (list(self.queue.get()), list(self.cache.get())))

    def _take(self, key, m: Memory, new: dict, waiting: int) -> tuple[list[tuple], int]:
        """The rows of all chunks whose turn it is, from new ones and those that wait, and how many still wait in the state."""
        if 0 < waiting <= HELD:
            new.update({k[0]: v for k, v in self.early.iterator()})  # of a chunk that came twice the first counts
            self.early.clear()
            waiting = 0
        out = []
        while True:
            own = new.pop(m.next, None)
            if waiting and self.early.containsKey((m.next,)):
                own = self.early.getValue((m.next,))
                self.early.removeKey((m.next,))
                waiting -= 1
            if own is None:
                return out, waiting
            chunk, first, (n, x) = m.next, m.frames, own
            for i, p in enumerate(m.take(np.array(x, float).reshape(n, self.width), self.score).tolist()):
                out.append(self._row(key, m, chunk, first + i, p))

    def _keep(self, new: dict, waiting: int) -> int:
        """Chunks before their turn go to the state."""
        for chunk, own in new.items():
            if not (waiting and self.early.containsKey((chunk,))):
                self.early.updateValue((chunk,), own)
                waiting += 1
        new.clear()
        return waiting

    def _row(self, key, m: Memory, chunk=None, frame=None, p=None, ended=False, waiting=0) -> tuple:
        return str(key[0]), chunk, frame, p, len(m.cache[0]), ended, waiting

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        m, timer, last, waiting = self._load()
        new, moved = {}, False
        for part in rows:
            last = max(last, int(part["ts"].max().timestamp() * 1000))
            for chunk, x in zip(part["chunk"].tolist(), part["x"]):
                if chunk >= m.next and chunk not in new:
                    own = np.array([list(v) for v in x], float).reshape(-1, self.width)
                    new[chunk] = len(own), own.ravel().tolist()
            if m.next in new:
                if not moved:
                    self._frames(m)
                    moved = True
                out, waiting = self._take(key, m, new, waiting)
                if out:
                    yield _frame(out)
            if len(new) > HELD:
                waiting = self._keep(new, waiting)
        waiting = self._keep(new, waiting)
        if not timer:
            timer = last + int(1000 * self.idle)
            self.handle.registerTimer(timer)
        self.head.update((m.next, m.frames, m.silent, m.mean.tolist(), timer, last, waiting))
        if moved:
            for state, (x, p) in ((self.queue, m.queue), (self.cache, m.cache)):
                if len(x):
                    state.put([(a, b) for a, b in zip(x.tolist(), p.tolist())])
                else:
                    state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        m, _, last, waiting = self._load()
        due = last + int(1000 * self.idle)
        if due > expiredTimerInfo.getExpiryTimeInMs() and due >= timerValues.getCurrentWatermarkInMs():  # chunks have come since it was set
            self.handle.registerTimer(due)
            self.head.update((m.next, m.frames, m.silent, m.mean.tolist(), due, last, waiting))
            return
        self._frames(m)
        for state in (self.head, self.queue, self.cache, self.early):
            state.clear()
        yield _frame([self._row(key, m, m.next, m.frames, None, True, waiting)])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip([x.split()[0] for x in OUTPUT.split(", ")], map(list, zip(*rows)))))


def scored_chunks(stream: DataFrame, score: Score, width: int, rule: Rule, queue_size: int, idle: float = 3600.0) -> DataFrame:
    """OUTPUT: a row a frame with its chances, and a last row of each source that has ended (its chunks and frames in chunk and frame).

    stream: (source, chunk from 0, x array<array<double>> of `width` numbers a frame, ts of the chunk, with a watermark). The session needs the
    RocksDB state store (ROCKS). Rows without a source or a chunk's number are left out; chunks that come again are dropped.
    """
    return stream.select("source", "chunk", "x", "ts").where("source is not null and chunk is not null and ts is not null").groupBy("source").transformWithStateInPandas(Chunks(score, width, rule, queue_size, idle), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
