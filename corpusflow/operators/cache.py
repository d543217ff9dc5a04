"""A bounded cache of frames: which frames of a source stay when it is compressed.

Every (frame, speaker) has a score: how clearly this speaker, and only this one, talks there. The clearest frames of each speaker
are raised twice, so that none is crowded out; each speaker also gets slots for the mean of silent frames; then the best `size`
of all (frame, speaker) stay. Ties: the higher score, then the earlier frame, then the smaller speaker.

`compress` is the kernel over one source's arrays, for state that lives in a stream; `compressed` does the same for any number of sources
as windows. Both give the slots in the order speaker, frame, with silence behind each speaker's frames and in slots that nothing fills.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    #: Slots of the cache and, of these, slots of silence for each speaker.
    size: int = 188
    silence: int = 3
    speakers: int = 4
    #: Chances below this count as this.
    floor: float = 0.25
    #: Shares of a speaker's quota: frames that are raised by 2 ln 2 and by ln 2, and clear frames from which on unclear ones go.
    strong: float = 0.75
    weak: float = 1.5
    clear: float = 0.5

    @property
    def quota(self) -> int:
        return self.size // self.speakers - self.silence

    def of_quota(self, share: float) -> int:
        return int(self.quota * share)


def _raised(scores: np.ndarray, n: int, by: float) -> None:
    for s in range(scores.shape[1]):
        best = np.argsort(-scores[:, s], kind="stable")[:n]
        scores[best[np.isfinite(scores[best, s])], s] += by


def frame_scores(p: np.ndarray, rule: Rule) -> np.ndarray:
    """(frames, speakers): the raised scores; minus infinity where the speaker doesn't talk or isn't clear."""
    alone = np.log(np.maximum(1 - p, rule.floor))
    scores = np.log(np.maximum(p, rule.floor)) - alone + alone.sum(axis=1, keepdims=True) + np.log(2)
    enough = (scores > 0).sum(axis=0) >= rule.of_quota(rule.clear)
    scores[(p <= 0.5) | ((scores <= 0) & enough)] = -np.inf
    _raised(scores, rule.of_quota(rule.strong), 2 * np.log(2))
    _raised(scores, rule.of_quota(rule.weak), np.log(2))
    return scores


def compress(p: np.ndarray, rule: Rule) -> np.ndarray:
    """The frames that the cache's slots take, -1 for silence; p: chances (frames, speakers). Without a quota for frames the first ones stay."""
    if rule.quota <= 0:
        return np.arange(min(rule.size, len(p)))
    scores = frame_scores(p, rule)
    frame, speaker = np.indices(scores.shape)
    best = np.lexsort((speaker.ravel(), frame.ravel(), -scores.ravel()))[: rule.size - rule.silence * rule.speakers]
    best = best[np.isfinite(scores.ravel()[best])]
    slots = [np.append(np.sort(frame.ravel()[best[speaker.ravel()[best] == s]]), [-1] * rule.silence) for s in range(rule.speakers)]
    out = np.concatenate(slots).astype(np.int64)
    return np.append(out, np.full(rule.size - len(out), -1))


def silence_mean(mean: np.ndarray, n: int, x: np.ndarray, p: np.ndarray, below: float = 0.2) -> tuple[np.ndarray, int]:
    """The running mean of silent frames (chances below `below` in sum) and their number, with the frames x."""
    quiet = x[p.sum(axis=1) < below]
    if not len(quiet):
        return mean, n
    return (mean * n + quiet.sum(axis=0)) / (n + len(quiet)), n + len(quiet)


def compressed(frames: DataFrame, source: str, rule: Rule) -> DataFrame:
    """(source, slot, speaker, frame, score) of frames (source, frame, speaker, p); frame is null in slots of silence, speaker where nothing fills a slot.

    Null chances count as 0. Speakers beyond the rule's are left out.
    """
    if rule.quota <= 0:
        raise ValueError("the size leaves no slot for frames")
    p = F.coalesce(F.col("p"), F.lit(0.0))
    low = lambda c: F.ln(F.greatest(c, F.lit(rule.floor)))
    each = frames.where(F.col("speaker").between(0, rule.speakers - 1)).select(source, "frame", "speaker", p.alias("p"))
    at = Window.partitionBy(source, "frame")
    each = each.withColumn("score", low(F.col("p")) - low(1 - F.col("p")) + F.sum(low(1 - F.col("p"))).over(at) + F.ln(F.lit(2.0)))
    by = Window.partitionBy(source, "speaker")
    enough = F.count_if(F.col("score") > 0).over(by) >= rule.of_quota(rule.clear)
    each = each.withColumn("__enough", enough).where((F.col("p") > 0.5) & ((F.col("score") > 0) | ~F.col("__enough")))

    def raised(df: DataFrame, n: int, by_: float) -> DataFrame:
        return df.withColumn("__at", F.row_number().over(by.orderBy(F.desc("score"), "frame"))).withColumn("score", F.col("score") + F.when(F.col("__at") <= n, by_).otherwise(0.0))

    each = raised(raised(each, rule.of_quota(rule.strong), 2 * float(np.log(2))), rule.of_quota(rule.weak), float(np.log(2)))
    best = F.row_number().over(Window.partitionBy(source).orderBy(F.desc("score"), "frame", "speaker"))
    own = each.withColumn("__best", best).where(F.col("__best") <= rule.size - rule.silence * rule.speakers).select(source, "speaker", "frame", "score")
    sources = frames.select(source).distinct()
    none: list[Column] = [F.lit(None).cast(t).alias(c) for c, t in (("frame", dict(frames.dtypes)["frame"]), ("score", "double"))]
    quiet = sources.select(source, F.explode(F.sequence(F.lit(0), F.lit(rule.speakers - 1))).alias("speaker"), *none)
    quiet = quiet.withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(rule.silence)))).drop("__k") if rule.silence else quiet.limit(0)
    slots = own.withColumn("speaker", F.col("speaker").cast("int")).unionByName(quiet)
    slot = F.row_number().over(Window.partitionBy(source).orderBy("speaker", F.asc_nulls_last("frame"))) - 1
    filled = slots.withColumn("slot", slot)
    n = filled.groupBy(source).agg(F.count("*").alias("__n"))
    rest = n.where(F.col("__n") < rule.size).select(source, F.explode(F.sequence(F.col("__n").cast("int"), F.lit(rule.size - 1))).alias("slot"), F.lit(None).cast("int").alias("speaker"), *none)
    # without any slot of silence, a source of which no frame stays has no row above
    if not rule.silence:
        rest = rest.unionByName(sources.join(n, source, "left_anti").select(source, F.explode(F.sequence(F.lit(0), F.lit(rule.size - 1))).alias("slot"), F.lit(None).cast("int").alias("speaker"), *none))
    return filled.select(source, "slot", "speaker", "frame", "score").unionByName(rest)
