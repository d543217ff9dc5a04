"""Threshold filters with their accounting, distributions and previews.

Filters set a flag; nothing is deleted. Directions: crest, music and spoof margin delete above their threshold,
MOS deletes below it; equal values stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_even
from ..functions.text import truthy
from .partitioning import beside, percentiles

ABOVE, BELOW = "above", "below"
# The percentiles of a distribution report.
PERCENTILES = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95)
BINS = 10


def deleted_by(score: Column, threshold: float, side: str, digits: int | None = None) -> Column:
    """Whether the score fails; null scores don't."""
    s = score if digits is None else round_even(score, digits)
    return F.coalesce(s > threshold if side == ABOVE else s < threshold, F.lit(False))


def crest_filter(df: DataFrame, threshold: float = 10.0) -> DataFrame:
    return df.withColumn("deleted", deleted_by(F.col("crest_factor"), threshold, ABOVE))


def music_filter(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("deleted", deleted_by(F.col("music_prob"), threshold, ABOVE, 6))


def mos_filter(df: DataFrame, threshold: float) -> DataFrame:
    if not threshold > 0:
        raise ValueError("the MOS threshold must be above 0")
    return df.withColumn("deleted", deleted_by(F.col("DistillMOS"), threshold, BELOW))


def spoof_margin(df: DataFrame, bonafide: str = "score_bonafide", spoof: str = "score_spoof") -> DataFrame:
    """Rows with both scores and their margin, spoof less bonafide."""
    b, s = F.col(bonafide).try_cast("double"), F.col(spoof).try_cast("double")
    return df.withColumn("margin", s - b).where(F.col("margin").isNotNull())


def spoof_filter(df: DataFrame, threshold: float = 0.0) -> DataFrame:
    return spoof_margin(df).withColumn("deleted", deleted_by(F.col("margin"), threshold, ABOVE))


def class_scores(df: DataFrame, scores: str) -> DataFrame:
    """Two class scores: index 1 is bonafide, 0 is spoof; fewer are an error."""
    x = F.when(F.size(scores) < 2, F.raise_error(F.lit("two class scores are needed"))).otherwise(F.col(scores))
    return df.withColumn("score_bonafide", F.get(x, F.lit(1)).cast("double")).withColumn("score_spoof", F.get(x, F.lit(0)).cast("double"))


def hours(seconds: Column) -> Column:
    return F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600


def audit(df: DataFrame, duration: str = "total_duration", deleted: str = "deleted", *by: str) -> DataFrame:
    """Files and hours before and after a filter, in one pass with partial sums; deleted may be text."""
    gone = F.coalesce(F.col(deleted), F.lit(False)) if dict(df.dtypes)[deleted] == "boolean" else truthy(F.col(deleted), extra=False)
    seconds = F.coalesce(F.col(duration).cast("double"), F.lit(0.0))
    out = df.groupBy(*by).agg(
        F.count("*").alias("files_in"),
        F.count_if(~gone).alias("files_out"),
        hours(seconds).alias("h_in"),
        hours(F.when(~gone, seconds)).alias("h_out"),
    )
    return out.select(
        *by, "files_in", "files_out", round_even(F.col("h_in"), 4).alias("hours_in"), round_even(F.col("h_out"), 4).alias("hours_out"),
        round_even(F.greatest(F.col("h_in") - F.col("h_out"), F.lit(0.0)), 4).alias("hours_removed"),
    )


def baseline_audit(scored: DataFrame, deleted: DataFrame, key: str = "filepath", duration: str = "total_duration") -> DataFrame:
    """The audit of a filter that only knows what it deleted: in is what was scored, out is in less deleted."""
    gone = deleted.select(F.col(key).alias("__gone")).distinct().withColumn("__g", F.lit(True))
    return audit(scored.join(gone, scored[key] == F.col("__gone"), "left").withColumn("deleted", F.coalesce("__g", F.lit(False))), duration)


def distribution(df: DataFrame, score: str, *by: str, digits: int = 6) -> DataFrame:
    """Count, extremes, mean, sample deviation and linearly interpolated percentiles of the scores that are there."""
    own = df.where(F.col(score).isNotNull())
    q = own.groupBy(*by).agg(F.count(score).alias("count"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"))
    q = beside(q, percentiles(own, list(by), score, list(PERCENTILES)), list(by))
    stats = [F.round(c, digits).alias(c) for c in ("min", "max", "mean", "std")]
    return q.select(*by, "count", *stats, *[F.round(F.get("q", F.lit(i)), digits).alias(f"p{round(p * 100):02d}") for i, p in enumerate(PERCENTILES)])


def histogram(df: DataFrame, score: str, duration: str | None = None, bins: int = BINS) -> DataFrame:
    """Equal-width bins [low, high), the last closed; files and hours in each. Scores that are all equal are in one bin.

    The range is one row, so its join costs nothing; the count is a partial aggregate of at most `bins` keys a task.
    """
    own = df.where(F.col(score).isNotNull())
    span = own.agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(score) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    seconds = F.coalesce(F.col(duration).cast("double"), F.lit(0.0)) if duration else F.lit(0.0)
    placed = own.crossJoin(F.broadcast(span)).select(index.cast("int").alias("bin"), "lo", width.alias("w"), seconds.alias("s"))
    out = placed.groupBy("bin").agg(F.count("*").alias("files"), hours(F.col("s")).alias("h"), F.first("lo").alias("lo"), F.first("w").alias("w"))
    return out.select("bin", F.round(F.col("lo") + F.col("bin") * F.col("w"), 6).alias("low"), F.round(F.col("lo") + (F.col("bin") + 1) * F.col("w"), 6).alias("high"), "files", F.round("h", 4).alias("hours"))


def preview(df: DataFrame, score: str, duration: str, threshold: float, side: str) -> DataFrame:
    """What a threshold would delete and save, over scored rows."""
    own = df.where(F.col(score).isNotNull())
    gone = deleted_by(F.col(score), threshold, side)
    s = F.coalesce(F.col(duration).cast("double"), F.lit(0.0))
    return own.agg(
        F.count_if(gone).alias("delete_files"), F.count_if(~gone).alias("save_files"),
        F.round(hours(F.when(gone, s)), 4).alias("delete_hours"), F.round(hours(F.when(~gone, s)), 4).alias("save_hours"),
    )


def finite(df: DataFrame, column: str) -> DataFrame:
    """Rows with a finite number; booleans are numbers."""
    c = F.col(column).cast("double")
    return df.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def trim_percentiles(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Finite values between two percentiles; all of them if none would be left."""
    own = finite(df, column)
    edges = percentiles(own, [], column, [low, high]).select(F.col("q").alias("__q")).select(F.get("__q", F.lit(0)).alias("__lo"), F.get("__q", F.lit(1)).alias("__hi"))
    return own.crossJoin(F.broadcast(edges)).where(F.col(column).between(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")


def resolve_threshold(given: float | None = None, configured: float | None = None, manual: bool = False) -> float:
    """The threshold of a run: the one given, else, unless a manual run is asked for, the configured one. Nothing is prompted for."""
    if given is not None:
        return given
    if configured is not None and not manual:
        return configured
    raise ValueError("a manual run needs a threshold" if manual else "no threshold is given or configured")


def class_of(probability: Column, threshold: float = 0.4) -> Column:
    """1 above the threshold."""
    return (probability > threshold).cast("int")
