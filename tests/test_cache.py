"""The frame cache and the state of chunked sources."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators.cache import Rule, compress, compressed, silence_mean
from corpusflow.streaming import sources

RULES = [Rule(size=24, silence=1, speakers=3), Rule(size=20, silence=3, speakers=4), Rule(size=12, silence=0, speakers=2), Rule(size=40, silence=2, speakers=2)]


def chances(seed, n, speakers):
    rng = np.random.default_rng(seed)
    p = rng.choice([0.0, 0.1, 0.3, 0.6, 0.8, 0.95, 1.0], (n, speakers))  # many ties
    return np.where(rng.random((n, 1)) < 0.3, p * 0.1, p)


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("n", [0, 1, 30, 200])
def test_kernel_and_windows_agree(spark, rule, n):
    got, want = {}, {}
    rows = []
    for s in range(3):
        p = chances(s + n, n, rule.speakers)
        want[s] = compress(p, rule).tolist()
        rows += [(s, f, k, float(v)) for f, line in enumerate(p) for k, v in enumerate(line)]
    frames = spark.createDataFrame(rows, "source int, frame int, speaker int, p double")
    for r in compressed(frames, "source", rule).orderBy("source", "slot").collect():
        got.setdefault(r.source, []).append(-1 if r.frame is None else r.frame)
    assert got == ({} if n == 0 else want)


def test_compress_by_hand():
    rule = Rule(size=8, silence=1, speakers=2)  # a quota of 3: two frames raised strongly, four weakly
    p = np.array([[0.9, 0.1], [0.8, 0.1], [0.7, 0.1], [0.6, 0.1], [0.1, 0.6], [0.9, 0.9], [0.1, 0.1], [0.9, 0.1]])
    slots = compress(p, rule).tolist()
    assert len(slots) == 8 and slots[-1] == -1
    assert 4 in slots  # the only frame of the second speaker isn't crowded out
    assert slots[: slots.index(-1)] == [0, 1, 2, 3, 7][: slots.index(-1)] or slots[0] == 0
    assert 6 not in slots
    with pytest.raises(ValueError):
        compressed(None, "source", Rule(size=4, silence=3, speakers=4))
    assert compress(p, Rule(size=4, silence=3, speakers=2)).tolist() == [0, 1, 2, 3]


def test_silence_mean_is_running():
    x, p = np.arange(12.0).reshape(6, 2), np.array([[0.1, 0.0], [0.9, 0.0], [0.0, 0.0], [0.19, 0.0], [0.1, 0.1], [0.0, 0.1]])
    mean, n = silence_mean(np.zeros(2), 0, x[:3], p[:3])
    mean, n = silence_mean(mean, n, x[3:], p[3:])
    quiet = x[p.sum(axis=1) < 0.2]
    assert n == len(quiet) and mean == pytest.approx(quiet.mean(axis=0))
    assert silence_mean(mean, n, x[:0], p[:0])[1] == n


RULE = Rule(size=10, silence=1, speakers=2)


def scorer():
    """A function that the tasks don't look for in this file."""

    def score(kept, queued, chunk):
        """Depends on all that is remembered."""
        x = np.concatenate((kept, queued, chunk))
        return np.clip(np.stack((x[:, 0] + kept[:, 0].sum() / 50, x[:, 1] - queued[:, 1].sum() / 50), axis=1) % 1.0, 0, 1)

    return score


def made(seed=1, n_sources=4, n_chunks=9):
    rng = np.random.default_rng(seed)
    return {(f"s{s}", c): rng.random((3 if (s + c) % 4 else 2, 2)).round(3).tolist() for s in range(n_sources) for c in range(n_chunks)}


@pytest.mark.parametrize("batches", [1, 5])
def test_chunks_in_any_batching(spark, tmp_path, batches):
    chunks = made()
    want = {}
    for s in sorted({s for s, _ in chunks}):
        m, at = sources.Memory(2, RULE, 4), 0
        for c in range(9):
            for p in m.take(np.array(chunks[s, c]), scorer()).tolist():
                want[s, c, at] = p
                at += 1
        assert len(m.cache[0]) <= RULE.size and len(m.queue[0]) <= 4 + 3
    start = datetime(2024, 1, 1)
    rows = [(s, c, x, start + timedelta(seconds=c)) for (s, c), x in chunks.items()]
    rows += [rows[3], (None, 1, [[1.0, 1.0]], start), ("s0", None, [[1.0, 1.0]], start), ("gap", 1, [[0.5, 0.5]], start)]  # again; without a name; a first chunk that never comes
    random.Random(batches).shuffle(rows)
    schema = "source string, chunk long, x array<array<double>>, ts timestamp"
    for k in range(batches):
        spark.createDataFrame(rows[k::batches], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    # at last a row that is far ahead, so that all sources end
    late = spark.createDataFrame([("end", 5, [[0.1, 0.1]], start + timedelta(days=30))], schema)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", sources.ROCKS)
    try:
        for extra in (None, late):
            if extra is not None:
                extra.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("ts", "1 day")
            out = sources.scored_chunks(stream, scorer(), 2, RULE, 4, idle=60.0)
            out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = spark.read.schema(sources.OUTPUT).parquet(f"{tmp_path}/out")
    assert {(r.source, r.chunk, r.frame): r.p for r in got.where("not ended").collect()} == want
    assert got.where("not ended").count() == len(want)
    ended = {r.source: (r.chunk, r.waiting) for r in got.where("ended").collect()}
    assert ended == {**{f"s{s}": (9, 0) for s in range(4)}, "gap": (0, 1)}
    assert got.where(F.col("cached") > RULE.size + 4).count() == 0


class _States:
    """A handle whose states are in memory and which counts its calls."""

    def __init__(self):
        self.calls, self.values = 0, {}

    def state(self, name, *_):
        own, one = self, self.values

        class State:
            def __getattr__(self, call):
                def run(*args):
                    own.calls += 1
                    held = one.setdefault(name, {})
                    if call in ("update", "put"):
                        one[name] = {"v": args[0]}
                    elif call == "get":
                        return held.get("v") if name == "head" else iter(held.get("v", []))
                    elif call == "exists":
                        return bool(held)
                    elif call == "clear":
                        one[name] = {}
                    elif call == "containsKey":
                        return args[0] in held
                    elif call == "getValue":
                        return held[args[0]]
                    elif call == "updateValue":
                        held[args[0]] = args[1]
                    elif call == "removeKey":
                        del held[args[0]]
                    elif call == "iterator":
                        return iter(list(held.items()))

                return run

        return State()

    getValueState = getListState = getMapState = state

    def registerTimer(self, _):
        self.calls += 1

    deleteTimer = registerTimer


@pytest.mark.parametrize("held", [0, 3, 1_000])
def test_few_calls_of_the_state(monkeypatch, held):
    """Nine chunks in three batches, the first ones last: calls a batch and a chunk that waits, and the results of one batch in order."""
    import pandas as pd

    chunks = made(n_sources=1)
    m, want = sources.Memory(2, RULE, 4), []
    for c in range(9):
        want += m.take(np.array(chunks["s0", c]), scorer()).tolist()
    monkeypatch.setattr(sources, "HELD", held, raising=False)
    handle = _States()
    own = sources.Chunks(scorer(), 2, RULE, 4, 60.0)
    own.init(handle)
    got = []
    for third in (2, 1, 0):
        at = [*range(third, 9, 3), third]  # one comes again
        part = pd.DataFrame({"chunk": at, "x": [chunks["s0", c] for c in at], "ts": pd.Timestamp("2024-01-01")})
        for out in own.handleInputRows(("s0",), iter([part.iloc[:2], part.iloc[2:]]), None):
            got += out["p"].tolist()
    assert got == want
    assert not handle.values["early"]
    if held == 1_000:
        assert handle.calls <= 25  # 66 and more when each step asked the state
