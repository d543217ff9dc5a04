"""Manifest state: upserts, pending work, pruning and deduplication by an explicit sequence.

All are equi-joins on the key or windows over it, so Spark picks the join and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing


def keep_first(df: DataFrame, key: str | Sequence[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order."""
    return _ranked(df, key, [F.col(o) if isinstance(o, str) else o for o in order])


def keep_last(df: DataFrame, key: str | Sequence[str], *order: str) -> DataFrame:
    """The last row of each key: the latest wins."""
    return _ranked(df, key, [F.col(o).desc_nulls_last() for o in order])


def _ranked(df: DataFrame, key: str | Sequence[str], order: list[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The latest row of each key as an aggregate: a partial maximum before the shuffle instead of a window's sort."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__x"))
    return best.select(key, *[F.col(f"__x.{c}").alias(c) for c in cols])


def upsert(main: DataFrame, incoming: DataFrame, key: str = "filepath", preserve: bool = True) -> DataFrame:
    """main with incoming's columns. Keys may be new on either side.

    preserve: a null never erases a value. Otherwise an incoming row replaces even with null, and rows that
    did not come keep what they have. Both sides need one row a key.
    """
    new = incoming.select(F.col(key).alias("__key"), *[F.col(f"`{c}`").alias(f"__in_{c}") for c in incoming.columns if c != key]).withColumn("__came", F.lit(True))
    joined = main.join(new, main[key] == new["__key"], "full_outer")
    cols = [F.coalesce(main[key], F.col("__key")).alias(key)]
    for c in [c for c in main.columns if c != key]:
        if c not in incoming.columns:
            cols.append(main[c])
        elif preserve:
            cols.append(F.coalesce(F.col(f"__in_{c}"), main[c]).alias(c))
        else:
            cols.append(F.when(F.col("__came"), F.col(f"__in_{c}")).otherwise(main[c]).alias(c))
    cols += [F.col(f"__in_{c}").alias(c) for c in incoming.columns if c not in main.columns]
    return joined.select(*cols)


def replace_merge(main: DataFrame, incoming: DataFrame, key: str = "filepath") -> DataFrame:
    """incoming's columns replace main's as a whole: rows that did not come lose them."""
    kept = main.drop(*[c for c in incoming.columns if c != key])
    return kept.join(incoming, key, "full_outer")


def pending(work: DataFrame, manifest: DataFrame, columns: Sequence[str], key: str = "filepath") -> DataFrame:
    """work whose manifest row lacks a value in any of the columns. False counts as done, blank text doesn't; duplicates stay."""
    if any(c not in manifest.columns for c in columns):
        return work
    done = manifest.where(reduce(lambda a, b: a & b, [has_value(manifest, c) for c in columns]))
    return work.join(done.select(F.col(key).alias("__done")).distinct(), work[key] == F.col("__done"), "left_anti")


def has_value(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    c = F.col(f"`{column}`")
    if kind == "string":
        return ~is_missing(c)
    return c.isNotNull() & (~F.isnan(c) if kind in ("double", "float") else F.lit(True))


def pending_sidecar(clips: DataFrame, sidecars: DataFrame, source: str | None, target: str, retry_empty: bool = False, key: str = "filepath") -> DataFrame:
    """clips that have the source sidecar (any clip if None) and not the target; retry_empty: an empty target is none."""
    out = clips
    if source is not None:
        have = sidecars.where(F.col("kind") == source).select(F.col(key).alias("__have")).distinct()
        out = out.join(have, out[key] == F.col("__have"), "left_semi")
    done = sidecars.where(F.col("kind") == target)
    if retry_empty:
        done = done.where(F.length("text") > 0)
    done = done.select(F.col(key).alias("__done")).distinct()
    return out.join(done, out[key] == F.col("__done"), "left_anti")


def prune_missing(manifest: DataFrame, listing: DataFrame, key: str = "filepath", listed: str = "path") -> DataFrame:
    """Rows whose file is still listed."""
    there = listing.select(F.col(listed).alias("__there")).distinct()
    return manifest.join(there, manifest[key] == F.col("__there"), "left_semi")


def union_distinct(manifest: DataFrame, found: DataFrame, key: str = "filepath") -> DataFrame:
    """The manifest's rows and those found that it lacks."""
    new = found.join(manifest.select(F.col(key).alias("__old")).distinct(), found[key] == F.col("__old"), "left_anti").dropDuplicates([key])
    return manifest.unionByName(new, allowMissingColumns=True)


def union_partials(parts: Sequence[DataFrame], key: str | None = None, *order: str) -> DataFrame:
    """All partial tables under one another, missing columns null; with a key, the last row of each."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return keep_last(out, key, *order) if key else out


def unseen(batch: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither in the state nor earlier in the batch."""
    new = batch.dropDuplicates([key])
    return new.join(state.select(F.col(key).alias("__seen")).distinct(), new[key] == F.col("__seen"), "left_anti")
