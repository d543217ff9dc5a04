"""Speaker segments: windows, single-speaker timelines, turn ends, clip metrics, frames and words.

Sources are partitions. Operators are windows over a source's segments, which spill; the timeline, an order-dependent fold, streams over sorted
segments and holds only the turns that may still change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_even

def parse_segments(df: DataFrame, source: str, raw: str) -> DataFrame:
    """(source, pos, seg_start, seg_end, speaker) from an array of "start end speaker_k" texts; what doesn't parse is left out."""
    parts = df.select(source, F.posexplode(raw).alias("pos", "__t")).withColumn("__p", F.split(F.trim("__t"), r"\s+"))
    out = parts.select(
        source, "pos", F.get("__p", F.lit(0)).try_cast("double").alias("seg_start"), F.get("__p", F.lit(1)).try_cast("double").alias("seg_end"),
        F.regexp_extract(F.coalesce(F.get("__p", F.lit(2)), F.lit("")), r"(\d+)$", 1).try_cast("int").alias("speaker"),
    )
    return out.where("seg_start is not null and seg_end is not null and speaker is not null and seg_end > seg_start")


def windows(df: DataFrame, source: str, duration: str, length: float = 900.0) -> DataFrame:
    """(source, window, offset, window_end): fixed windows of each source."""
    n = F.greatest(F.ceil(F.col(duration) / length), F.lit(1)).cast("int")
    each = df.withColumn("window", F.explode(F.sequence(F.lit(0), n - 1)))
    return each.withColumn("offset", F.col("window") * F.lit(length)).withColumn("window_end", F.least(F.col("offset") + length, F.col(duration)))


def drop_window_edges(segments: DataFrame, source: str, window: str, order: list[str], long_source: Column) -> DataFrame:
    """Without the first and last segment of each window that has more than two, in sources longer than a window."""
    w = Window.partitionBy(source, window)
    up, down = w.orderBy(*order), w.orderBy(*[F.col(o).desc() for o in order])
    ranked = segments.withColumns({"__up": F.row_number().over(up), "__down": F.row_number().over(down), "__n": F.count("*").over(w)})
    edge = long_source & (F.col("__n") > 2) & ((F.col("__up") == 1) | (F.col("__down") == 1))
    return ranked.where(~F.coalesce(edge, F.lit(False))).drop("__up", "__down", "__n")


def timeline(segments: DataFrame, source: str, most: float = 15.0) -> DataFrame:
    """(source, turn, start, end, speaker): turns of one speaker at a time.

    In order of (start, end, position): the same speaker goes on if it starts no later than the turn ends; another that
    overlaps takes over half way, and a turn that half way leaves nothing of is dropped. Turns longer than `most` are cut
    into pieces of it (most <= 0: not).
    """
    of = segments.schema[source]
    own = segments.select(source, F.col("seg_start").cast("double").alias("s"), F.col("seg_end").cast("double").alias("e"), "pos", F.col("speaker").cast("int").alias("spk"))
    schema = T.StructType([of, *T.StructType.fromDDL("turn int, s double, e double, spk int")])
    # a source's rows stream through one task, which holds the turns that a later segment can still reach
    turns = own.repartition(source).sortWithinPartitions(source, "s", "e", "pos").drop("pos").mapInArrow(_fold(source), schema)
    turns = turns.select(source, "turn", F.struct("s", "e", "spk").alias("x"))
    length = F.col("x.e") - F.col("x.s")
    n = F.greatest(F.ceil(length / most), F.lit(1)).cast("int") if most > 0 else F.lit(1)
    pieces = turns.withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("x.s") + F.col("piece") * F.lit(float(most)) if most > 0 else F.col("x.s")
    end = F.least(F.col("x.s") + (F.col("piece") + 1) * F.lit(float(most)), F.col("x.e")) if most > 0 else F.col("x.e")
    return pieces.select(source, "turn", "piece", start.alias("start"), end.alias("end"), F.col("x.spk").alias("speaker"))


def _fold(source: str):
    """(source, turn, s, e, spk): the turns of sorted segments (source, s, e, spk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, n = None, [], 0  # the source, its turns that may still change, and how many it has given
        for batch in batches:
            keys, out = [], []

            def settle(until: float) -> None:
                nonlocal n, open_
                k = 0
                while k < len(open_) and open_[k][1] < until:
                    keys.append(now)
                    out.append((n, *open_[k]))
                    k, n = k + 1, n + 1
                open_ = open_[k:]

            for key, s, e, spk in zip(*(batch.column(c).to_pylist() for c in (source, "s", "e", "spk"))):
                if key != now:
                    settle(float("inf"))
                    now, n = key, 0
                settle(s)  # no segment from here on starts before
                if open_ and open_[-1][2] == spk and s <= open_[-1][1]:
                    open_[-1] = (open_[-1][0], max(open_[-1][1], e), spk)
                elif open_ and open_[-1][2] != spk and s < open_[-1][1]:
                    start, end, other = open_.pop()
                    middle = (s + end) / 2
                    if middle > start:
                        open_.append((start, middle, other))
                    if e > middle:
                        open_.append((middle, e, spk))
                else:
                    open_.append((s, e, spk))
            yield _turns(batch.schema.field(source).type, source, keys, out)
        rest = [(n + i, *t) for i, t in enumerate(open_)]
        if rest:
            yield _turns(batch.schema.field(source).type, source, [now] * len(rest), rest)

    return run


def _turns(kind: pa.DataType, source: str, keys: list, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.float64(), pa.int32())))], [source, "turn", "s", "e", "spk"])


def turn_ends(segments: DataFrame, source: str, most: float = 15.0, least: float = 1.0, gap: float = 0.5) -> DataFrame:
    """(source, start, end, speaker): segments merged up to a predicted end of turn.

    A turn goes on while the speaker stays and the gap is no longer than `gap`; it counts only if its last segment has prediction 1.
    Longer ones keep their last `most` seconds, those shorter than `least` go.
    """
    w = Window.partitionBy(source).orderBy("seg_start", "seg_end", "pos")
    prev = {c: F.lag(c).over(w) for c in ("speaker", "seg_end", "prediction")}
    new = prev["speaker"].isNull() | (prev["prediction"] == 1) | (prev["speaker"] != F.col("speaker")) | (F.col("seg_start") - prev["seg_end"] > gap)
    marked = segments.withColumn("__new", new.cast("int"))
    marked = marked.withColumn("__turn", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("seg_start", "seg_end", "pos")
    turns = marked.groupBy(source, "__turn").agg(F.min("seg_start").alias("s"), F.max_by("seg_end", at).alias("end"), F.max_by("prediction", at).alias("p"), F.first("speaker").alias("speaker"))
    out = turns.where("p = 1").withColumn("start", F.greatest(F.col("s"), F.col("end") - most))
    return out.where(F.col("end") - F.col("start") >= least).select(source, "start", "end", "speaker")


#: The shortest bins, in seconds, and levels of bins that are twice as long each: over a year.
SHORTEST, LEVELS = 0.25, 28


def levelled(df: DataFrame, start: str, end: str) -> DataFrame:
    """df with __level and __bin: each interval on the one level whose bins are no shorter than it, so it lies in two bins at most; a row for each."""
    length = F.greatest(F.col(end) - F.col(start), F.lit(SHORTEST))
    level = F.least(F.ceil(F.log2(length / SHORTEST)), F.lit(LEVELS)).cast("int")
    width = F.pow(F.lit(2.0), F.col("__level")) * SHORTEST
    bins = F.array_distinct(F.transform(F.array(F.col(start), F.col(end)), lambda x: F.floor(x / width)))
    # beyond the longest bins an interval may lie in more than two
    bins = F.when(F.col("__level") < LEVELS, bins).otherwise(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))).withColumn("__level", level).withColumn("__bin", F.explode(bins))


def overlaps(clips: DataFrame, segments: DataFrame, source: str) -> DataFrame:
    """clips with each segment of their source that overlaps (touching doesn't), clipped to the clip as s, e.

    Both sides lie on levels of bins by their lengths, in two bins at most, whatever the lengths are. A pair meets on the coarser of its levels, so an interval
    has two rows for its own level and two for each level above it that the other side has. A pair counts in the bin in which its overlap starts.
    """
    width = F.pow(F.lit(2.0), F.col("__level")) * SHORTEST
    own = lambda df: df.select("*", F.col("__level").alias("__on"))
    c, g = levelled(clips, "clip_start", "clip_end"), levelled(segments, "seg_start", "seg_end")
    have = [d.select("__level").distinct().agg(F.collect_set("__level")).first()[0] for d in (c, g)]  # 29 numbers at most

    def raised(df: DataFrame, start: str, end: str, levels: list[int]) -> DataFrame:
        """The rows on each of these levels above their own."""
        up = F.filter(F.array(*[F.lit(x).cast("int") for x in sorted(levels)]), lambda x: x > F.col("__level"))
        each = df.where(F.col("__bin") == F.floor(F.col(start) / width)).withColumn("__on", F.explode(up))
        on = F.pow(F.lit(2.0), F.col("__on")) * SHORTEST
        return each.withColumn("__bin", F.explode(F.array_distinct(F.array(F.floor(F.col(start) / on), F.floor(F.col(end) / on)))))

    s, e = F.greatest("clip_start", "seg_start"), F.least("clip_end", "seg_end")

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({source: "__source", "__on": "__son", "__bin": "__sbin"}).drop("__level")
        on = F.pow(F.lit(2.0), F.col("__on")) * SHORTEST
        joined = a.drop("__level").join(b, (F.col(source) == F.col("__source")) & (F.col("__on") == F.col("__son")) & (F.col("__bin") == F.col("__sbin")) & (s < e))
        return joined.withColumns({"s": s, "e": e}).where(F.floor(F.col("s") / on) == F.col("__bin")).drop("__bin", "__sbin", "__source", "__on", "__son")

    # segments no longer than the clip, level by level, and then those that are longer
    low = met(own(c), own(g).unionByName(raised(g, "seg_start", "seg_end", have[0])))
    return low.unionByName(met(raised(c, "clip_start", "clip_end", have[1]), own(g)))


def clip_metrics(clips: DataFrame, segments: DataFrame, source: str, clip: str) -> DataFrame:
    """(clip, silence_percent, max_silence_duration, n_speakers): speech is the union of the clip's segments.

    No speech: 100 and the whole duration; no duration: zeros. clips: (clip, source, clip_start, clip_end); clips of one number count as one, whose bounds
    are those of its first segment's.
    """
    part = overlaps(clips, segments, source)
    w = Window.partitionBy(clip).orderBy("s", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    # a gap before each segment is silence; what is left is the end
    part = part.withColumn("__gap", F.greatest(F.col("s") - F.coalesce(before, F.col("clip_start")), F.lit(0.0)))
    sums = part.groupBy(clip).agg(
        F.sum("__gap").alias("gaps"), F.max("__gap").alias("gap"), F.max("e").alias("last"), F.countDistinct("speaker").alias("n"), F.min_by(F.struct("clip_start", "clip_end"), F.struct("s", "e")).alias("c"),
    )
    sums = sums.select(clip, "gaps", "gap", "last", "n", F.col("c.clip_start").alias("cs"), F.col("c.clip_end").alias("ce"))
    sums = sums.withColumn("tail", F.col("ce") - F.col("last"))
    sums = sums.select(F.col(clip).alias("__clip"), ((F.col("gaps") + F.col("tail")) / F.nullif(F.col("ce") - F.col("cs"), F.lit(0.0)) * 100).alias("p"), F.greatest("gap", "tail").alias("g"), "n")
    out = clips.join(sums, clips[clip] == F.col("__clip"), "left")
    length = F.col("clip_end") - F.col("clip_start")
    none = length <= 0
    return out.select(
        clips[clip],
        F.when(none, 0.0).otherwise(round_even(F.coalesce("p", F.lit(100.0)), 2)).alias("silence_percent"),
        F.when(none, 0.0).otherwise(round_even(F.coalesce("g", length), 2)).alias("max_silence_duration"),
        F.when(none, 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_speakers"),
    )


def clip_rows(clips: DataFrame, segments: DataFrame, source: str, clip: str) -> DataFrame:
    """Metadata of each clip: metrics, whether one speaker talks, and the first speaker (-1 when none does)."""
    first = overlaps(clips, segments, source).groupBy(clip).agg(F.min_by("speaker", F.struct("s", "e", "speaker")).alias("speaker_id"))
    m = clip_metrics(clips, segments, source, clip).join(first, clip, "left")
    return m.withColumn("speaker_id", F.coalesce("speaker_id", F.lit(-1))).withColumn("is_single_speaker", F.col("n_speakers") == 1).drop("n_speakers")


def hysteresis(frames: DataFrame, source: str, duration: str | None = None, onset: float = 0.5, offset: float = 0.5, min_on: float = 0.0, min_off: float = 0.0, pad_on: float = 0.0, pad_off: float = 0.0, step: float = 0.08) -> DataFrame:
    """(source, speaker, start, end) of speech from frame probabilities (source, frame, speaker, p).

    Speech starts at p >= onset and ends at p < offset; gaps up to min_off close, shorter speech than min_on goes, what is left is padded
    inside the source and joined again.
    """
    w = Window.partitionBy(source, "speaker").orderBy("frame")
    whole = Window.partitionBy(source, "speaker")
    on = F.when(F.col("p") >= onset, 1).when(F.col("p") < offset, 0)
    state = frames.withColumn("__on", F.coalesce(F.last(on, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    state = state.withColumns({"__new": ((F.col("__on") == 1) & (F.coalesce(F.lag("__on").over(w), F.lit(0)) == 0)).cast("int"), "__total": (F.max("frame").over(whole) + 1) * step})
    state = state.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = state.where("__on = 1").groupBy(source, "speaker", "__run").agg(
        (F.min("frame") * step).alias("start"), ((F.max("frame") + 1) * step).alias("end"), F.first("__total").alias("__total"), *([F.first(duration).alias("__limit")] if duration else [])
    )
    joined = _join_runs(runs, source, min_off, duration is not None)
    kept = joined.where(F.col("end") - F.col("start") >= min_on)
    limit = F.col("__limit") if duration else F.col("__total")
    padded = kept.withColumns({"start": F.greatest(F.col("start") - pad_on, F.lit(0.0)), "end": F.least(F.col("end") + pad_off, limit)})
    return (_join_runs(padded, source, 0.0, duration is not None) if pad_on or pad_off else padded).select(source, "speaker", "start", "end")


def _join_runs(runs: DataFrame, source: str, gap: float, limited: bool) -> DataFrame:
    w = Window.partitionBy(source, "speaker").orderBy("start", "end")
    end = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("__n", F.coalesce(F.col("start") - end > gap, F.lit(True)).cast("int"))
    marked = marked.withColumn("__i", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    keep = ["__total", *(["__limit"] if limited else [])]
    return marked.groupBy(source, "speaker", "__i").agg(F.min("start").alias("start"), F.max("end").alias("end"), *[F.first(k).alias(k) for k in keep])


def median_filter(frames: DataFrame, source: str, width: int) -> DataFrame:
    """p as the median of `width` frames around each."""
    w = Window.partitionBy(source, "speaker").orderBy("frame").rowsBetween(-(width // 2), width // 2)
    near = frames.withColumn("__near", F.array_sort(F.collect_list("p").over(w)))  # median() takes no moving frame
    n = F.size("__near")
    middle = (F.get("__near", F.floor((n - 1) / 2).cast("int")) + F.get("__near", F.floor(n / 2).cast("int"))) / 2
    return near.withColumn("p", middle).drop("__near")


def word_times(chars: DataFrame, clip: str, tokens: str, times: str) -> DataFrame:
    """(clip, words array<struct<start,end,word>>) from single tokens and their times.

    A blank token closes the word at its own time; the last word ends with the last time. Lists of different lengths have no words.
    """
    fine = chars.where((F.size(tokens) == F.size(times)) & (F.size(tokens) > 0))
    each = fine.select(clip, F.element_at(times, -1).alias("__last"), F.posexplode(F.arrays_zip(F.col(tokens).alias("c"), F.col(times).alias("t"))).alias("i", "x"))
    w = Window.partitionBy(clip).orderBy("i")
    blank = F.trim("x.c") == ""
    each = each.withColumn("__word", F.sum(blank.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - blank.cast("int")).withColumn("__blank", blank)
    words = each.groupBy(clip, "__word").agg(
        F.min(F.when(~F.col("__blank"), F.struct("i", F.col("x.t").alias("t")))).alias("first"),
        F.max(F.when(F.col("__blank"), F.col("x.t"))).alias("close"),
        F.max("__last").alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("__blank"), F.struct("i", F.col("x.c").alias("c"))))), lambda v: v["c"]), "").alias("word"),
    )
    words = words.where("first is not null")
    return words.select(clip, F.col("first.i").alias("i"), F.col("first.t").alias("start"), F.coalesce("close", "last").alias("end"), "word")


def words_tsv(words: DataFrame, clip: str) -> DataFrame:
    """A text of start, end, word lines for each clip."""
    line = F.format_string("%.3f\t%.3f\t%s", "start", "end", "word")
    return words.groupBy(clip).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", line.alias("l")))), lambda v: v["l"]), "\n").alias("text"))


def counter_deltas(samples: DataFrame, entity: str, order: list[str], ticks: str, clock: str) -> DataFrame:
    """Rate between samples in percent: ticks gained over time passed; an entity's first sample is 0."""
    w = Window.partitionBy(entity).orderBy(*order)
    d, t = F.col(ticks) - F.lag(ticks).over(w), F.col(clock) - F.lag(clock).over(w)
    return samples.withColumn("rate", F.coalesce(F.when(t > 0, F.greatest(d, F.lit(0)) / F.nullif(t, F.lit(0)) * 100), F.lit(0.0)))


def clamp(clips: DataFrame, duration: str, least: float = 0.5) -> DataFrame:
    """Clip ends inside their source; clips of no more than `least` seconds go."""
    out = clips.withColumn("clip_end", F.least("clip_end", duration))
    return out.where(F.col("clip_end") - F.col("clip_start") > least)
