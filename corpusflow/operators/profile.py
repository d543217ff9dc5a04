"""Dataset profiles: summaries, quantiles, correlations, buckets and ECDFs, each over all metrics at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent, ratio
from ..sinks.scratch import materialise
from .partitioning import beside, numbered, percentiles

# Metrics of a profile in their order, percentiles of its summaries.
CORE_METRICS = (
    "total_duration", "speech_duration", "silence_percent", "max_silence_duration", "crest_factor", "music_prob", "DistillMOS",
    "words_per_speech_minute", "words_per_total_minute", "chars_per_second",
)
DESCRIBE = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
TEXT_PRIORITY = ("accent", "punct", "rover")
IDS = ("filepath", "playlist_id", "podcast_id", "speaker_id", "start", "end")


def metric_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are neither ids nor places: core metrics first, in their order."""
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    own = [c for c, t in df.dtypes if t.startswith(kinds) and c not in IDS]
    return [*[c for c in CORE_METRICS if c in own], *[c for c in own if c not in CORE_METRICS]]


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Text columns of which at least one value is a number as numbers; one aggregation decides for all."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df
    some = df.agg(*[F.max(F.col(f"`{c}`").try_cast("double").isNotNull()).alias(str(i)) for i, c in enumerate(texts)]).first()
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for i, c in enumerate(texts) if some[i]})


def durations(df: DataFrame) -> DataFrame:
    """total_duration, else end less start; speech is what silence leaves."""
    total = F.coalesce(F.col("total_duration"), F.col("end") - F.col("start"))
    silence = F.greatest(F.least(F.coalesce(F.col("silence_percent"), F.lit(0.0)), F.lit(100.0)), F.lit(0.0))
    return df.withColumns({"total_duration": total, "speech_duration": total * (1 - silence / 100), "minutes": total / 60})


def first_text(columns: Sequence[str] = TEXT_PRIORITY) -> Column:
    """The first text that is not empty."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns])


def speech_rate(df: DataFrame, words: str = "n_words", chars: str = "n_chars") -> DataFrame:
    """Words a minute of speech and of all, characters a second; null without time."""
    speech, total = F.col("speech_duration"), F.col("total_duration")
    return df.withColumns({
        "words_per_speech_minute": ratio(F.col(words).cast("double"), speech / 60),
        "words_per_total_minute": ratio(F.col(words).cast("double"), total / 60),
        "chars_per_second": ratio(F.col(chars).cast("double"), total),
    })


def long_metrics(df: DataFrame, metrics: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., metric, value): one pass over the rows."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value")) for m in metrics])
    return df.select(*keep, F.explode(rows).alias("x")).select(*keep, "x.metric", "x.value")


def describe(df: DataFrame, metrics: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, moments, extremes and percentiles of each metric with what is missing."""
    m = long_metrics(df, metrics).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    out = m.groupBy("metric").agg(
        F.count("*").alias("rows"), F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    out = out.join(percentiles(m, ["metric"], "value", list(DESCRIBE)), "metric", "left")
    gone = F.col("rows") - F.col("count")
    return out.select(
        "metric", "count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "max")], *[F.round(F.get("q", F.lit(i)), digits).alias(f"p{round(q * 100):02d}") for i, q in enumerate(DESCRIBE)],
        gone.alias("missing"), F.round(percent(gone, F.col("rows")), 3).alias("missing_percent"),
    )


def core_summary(df: DataFrame, metrics: Sequence[str], digits: int = 6) -> DataFrame:
    """The same over finite values only, with sums and spread."""
    m = long_metrics(df, metrics).where("value is not null and not isnan(value) and abs(value) < double('infinity')")
    out = m.groupBy("metric").agg(
        F.count("*").alias("n"), F.sum("value").alias("sum"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    out = out.join(percentiles(m, ["metric"], "value", list(DESCRIBE)), "metric")
    q = [F.get("q", F.lit(i)) for i in range(len(DESCRIBE))]
    return out.select("metric", "n", F.round("sum", 2).alias("sum"), *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "max")], *[F.round(x, digits).alias(f"p{round(p * 100):02d}") for x, p in zip(q, DESCRIBE)], F.round(q[5] - q[3], digits).alias("iqr"))


def quantile_grid(df: DataFrame, metrics: Sequence[str], steps: int = 10, digits: int = 6) -> DataFrame:
    """(metric, q, value) for q from 0 to 1."""
    grid = [i / steps for i in range(steps + 1)]
    m = long_metrics(df, metrics).where("value is not null and not isnan(value) and abs(value) < double('infinity')")
    p = percentiles(m, ["metric"], "value", grid).withColumnRenamed("q", "v")
    return p.select("metric", F.posexplode("v").alias("i", "v")).select("metric", F.round(F.col("i") / steps, 6).alias("q"), F.round("v", digits).alias("value"))


#: Metrics up to which correlations are one row of aggregates; of more, tasks sum products of whole blocks.
WIDE = 24


def correlations(df: DataFrame, metrics: Sequence[str], digits: int = 6, wide: int = WIDE) -> DataFrame:
    """(metric_a, metric_b, corr) of pairwise complete rows, for metrics with more than one value.

    Few metrics are one aggregation with an expression a pair. Of more than `wide`, tasks sum the products of batches of rows, as matrices with masks of
    what is there, around rough means that keep the sums small; a task gives a row a pair. Both give the same.
    """
    good = {m: F.when(~F.isnan(F.col(f"`{m}`").cast("double")) & (F.abs(F.col(f"`{m}`").cast("double")) < float("inf")), F.col(f"`{m}`").cast("double")) for m in metrics}
    own = df.select(*[v.alias(m) for m, v in good.items()])
    if len(metrics) > wide:
        return _wide_correlations(own, list(metrics), digits)
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i:]]
    one = own.agg(*[(F.max(m) > F.min(m)).alias(f"v_{m}") for m in metrics], *[_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(x).alias("metric_a"), F.lit(y).alias("metric_b"), (F.col(f"v_{a}") & F.col(f"v_{b}")).alias("ok"), F.col(f"`{a}|{b}`").alias("c")) for a, b in pairs for x, y in dict.fromkeys([(a, b), (b, a)])])
    return one.select(F.explode(rows).alias("x")).where("x.ok").select("x.metric_a", "x.metric_b", F.round("x.c", digits).alias("corr"))


def _wide_correlations(own: DataFrame, metrics: list[str], digits: int) -> DataFrame:
    stats = own.agg(F.array(*[F.avg(f"`{m}`") for m in metrics]).alias("mean"), F.array(*[F.max(f"`{m}`") > F.min(f"`{m}`") for m in metrics]).alias("varies")).first()  # one row
    middle = np.array([x or 0.0 for x in stats["mean"]])
    k = len(metrics)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - middle
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(float)
            for total, more in zip(sums, (m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x)):  # row: the metric that is summed; column: the other, where it is there
                total += more
        a, b = np.triu_indices(k)
        n, s, q, p = sums
        cols = [a.astype(np.int32), b.astype(np.int32), n[a, b], s[a, b], s[b, a], q[a, b], q[b, a], p[a, b]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [x.split()[0] for x in _SUMS.split(", ")])

    each = own.mapInArrow(run, _SUMS).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "p")])
    spread = lambda q, s: F.sqrt(F.greatest(F.col(q) - F.col(s) * F.col(s) / F.col("n"), F.lit(0.0)))
    corr = (F.col("p") - F.col("sa") * F.col("sb") / F.nullif(F.col("n"), F.lit(0.0))) / F.nullif(spread("qa", "sa") * spread("qb", "sb"), F.lit(0.0))
    name = lambda i: F.get(F.array(*[F.lit(m) for m in metrics]), F.col(i))
    varies = F.array(*[F.lit(bool(v)) for v in stats["varies"]])
    some = each.where(F.get(varies, F.col("a")) & F.get(varies, F.col("b"))).select(name("a").alias("x"), name("b").alias("y"), F.round(F.when(F.col("n") > 1, corr), digits).alias("corr"))
    both = F.array_distinct(F.array(F.struct(F.col("x").alias("metric_a"), F.col("y").alias("metric_b")), F.struct(F.col("y").alias("metric_a"), F.col("x").alias("metric_b"))))
    return some.select(F.explode(both).alias("m"), "corr").select("m.metric_a", "m.metric_b", "corr")


_SUMS = "a int, b int, n double, sa double, sb double, qa double, qb double, p double"


def _corr(a: str, b: str) -> Column:
    """Pearson's correlation; null for a constant (corr() divides by zero there)."""
    both = F.stddev_samp(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_samp(F.when(F.col(a).isNotNull(), F.col(b)))
    return F.covar_samp(a, b) / F.nullif(both, F.lit(0.0))


#: Rows up to which all values are counted; values that a sketch of frequent ones tracks, and its error as a share of the rows times that number.
CATEGORY_ROWS, TRACKED, SKETCH_ERROR = 5_000_000, 10_000, 3.5


def categories(df: DataFrame, columns: Sequence[str], top: int = 50, most: int = CATEGORY_ROWS, tracked: int = TRACKED) -> DataFrame:
    """(column, value, n, percent, rank) of each column's most common values; null is <NA>, equal counts are ordered by value.

    Up to `most` rows all values are counted. Of more, mergeable sketches of frequent values give candidates, a second scan counts these exactly, and only they are
    sent. A column is settled so if its sketch held all its values, or if its last ranked count is above what any value can have
    that the sketch lost; of other columns (keys, say) all values are counted.
    """
    text = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<NA>")) for c in columns}
    long = lambda cs: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), text[c].alias("value")) for c in cs])).alias("x")).select("x.column", "x.value")
    rows = df.count()
    if rows <= most:
        return _ranked_values(long(columns).groupBy("column", "value").agg(F.count("*").alias("n")), rows, top)
    k = tracked // 3
    found = df.select(*[v.alias(f"c{i}") for i, v in enumerate(text.values())]).agg(*[F.expr(f"approx_top_k(c{i}, {k}, {tracked})").alias(f"c{i}") for i in range(len(columns))])
    each = F.array(*[F.struct(F.lit(c).alias("column"), (F.size(f"c{i}") < k).alias("all"), F.transform(f"c{i}", lambda x: x["item"]).alias("items")) for i, c in enumerate(columns)])
    # at most k values a column; written, so that Spark knows their size and sends them to all tasks only if they are small
    sketched = materialise(found.select(F.explode(each).alias("x")).select("x.column", "x.all", F.explode("x.items").alias("value")))
    candidates = sketched.select(F.col("column").alias("__c"), F.col("value").alias("__v"))
    counted = long(columns).join(candidates, (F.col("column") == F.col("__c")) & (F.col("value") == F.col("__v")), "left_semi").groupBy("column", "value").agg(F.count("*").alias("n"))
    counted = materialise(counted)
    ranked = _ranked_values(counted, rows, top)
    whole = {r[0] for r in sketched.where("all").select("column").distinct().collect()}  # a row a column
    sure = {r[0] for r in ranked.where((F.col("rank") == top) & (F.col("n") > 2 * SKETCH_ERROR * rows / tracked)).select("column").collect()}
    rest = [c for c in columns if c not in whole | sure]
    settled = ranked.where(F.col("column").isin(*sorted(whole | sure))) if whole | sure else ranked.limit(0)
    return settled.unionByName(_ranked_values(long(rest).groupBy("column", "value").agg(F.count("*").alias("n")), rows, top)) if rest else settled


def _ranked_values(counts: DataFrame, rows: int, top: int) -> DataFrame:
    order = [F.desc("n"), F.asc("value")]
    # the first of each part are found before one task ranks a column's
    part = Window.partitionBy("column", F.pmod(F.xxhash64("value"), F.lit(64))).orderBy(*order)
    some = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("column", "value", "n", F.round(percent(F.col("n"), F.lit(rows)), 3).alias("percent"), "rank")


def quantile_buckets(df: DataFrame, rate: str, buckets: int, values: Sequence[str], digits: int = 6) -> DataFrame:
    """Size, mean and median of values in buckets of equal share: right-closed, the lowest edge included, equal edges one."""
    # a few edges are taken as literals, so no row is joined to them
    row = percentiles(df, [], rate, [i / buckets for i in range(buckets + 1)]).first()
    edges = sorted(set(row["q"])) if row and row["q"] else [0.0]
    high = lambda i: F.get(F.array(*[F.lit(float(e)) for e in edges]), i)
    bucket = F.greatest(sum((F.lit(float(e)) < F.col(rate)).cast("int") for e in edges), F.lit(1))
    placed = df.where(F.col(rate).isNotNull()).withColumn("bucket", bucket)
    out = placed.groupBy("bucket").agg(F.count("*").alias("size"), *[F.round(F.avg(v), digits).alias(f"{v}_mean") for v in values])
    for v in values:
        middle = percentiles(placed, ["bucket"], v, [0.5]).select("bucket", F.round(F.get("q", F.lit(0)), digits).alias(f"{v}_median"))
        out = out.join(middle, "bucket", "left")
    return out.select("bucket", F.round(high(F.col("bucket") - 1), digits).alias("low"), F.round(high(F.col("bucket")), digits).alias("high"), "size", *[f"{v}_{s}" for v in values for s in ("mean", "median")])


def ecdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, n, y_first, y) of each distinct value: the places of its first and last row, spaced evenly from 0 to 1.

    Values are counted first, so the running sum goes over distinct values; in ranges, so no task sees a whole group.
    """
    n = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*by, value).agg(F.count("*").alias("n"))
    placed = numbered(n, list(by), [value], weight="n")
    placed = beside(placed, n.groupBy(*by).agg(F.sum("n").alias("__total")), list(by))
    last = F.greatest(F.col("__total") - 1, F.lit(1))
    return placed.withColumns({"y_first": F.round(F.col("__row") / last, 6), "y": F.round((F.col("__row") + F.col("n") - 1) / last, 6)}).drop("__row", "__total")


def real_time(df: DataFrame, wall: str, audio: str) -> DataFrame:
    """df with rtf, wall time over audio time, and x_realtime, its inverse; null on zero."""
    return df.withColumns({"rtf": ratio(F.col(wall), F.col(audio)), "x_realtime": ratio(F.col(audio), F.col(wall))})


def rollup(df: DataFrame, by: Sequence[str], columns: Sequence[str], digits: int = 6) -> DataFrame:
    """avg, max and min of each column; nulls don't count, and of nothing all three are null."""
    return df.groupBy(*by).agg(*[a for c in columns for a in (F.round(F.avg(c), digits).alias(f"{c}_avg"), F.max(c).alias(f"{c}_max"), F.min(c).alias(f"{c}_min"))])


def per_device(samples: DataFrame, devices: str, columns: Sequence[str]) -> DataFrame:
    """The same for each device of a nested list."""
    each = samples.select(F.explode(devices).alias("x")).select("x.*")
    return rollup(each, ["index"], columns)


def overview(df: DataFrame, duration: str, text: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"), F.round(F.coalesce(F.sum(duration), F.lit(0.0)) / 3600, 4).alias("hours"), F.count_if(F.coalesce(F.col(text), F.lit("")) != "").alias("with_text"))
