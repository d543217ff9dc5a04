"""Collation: the manifest with its text sidecars as columns, and what exports leave out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .consensus import agreement

# Columns that hold text.
TEXT_COLUMNS = (
    "accent", "rover", "punct", "phonemes", "rover_phonemes", "text", "transcript", "transcription", "giga_ctc", "giga_rnnt",
    "giga_ctc_lm", "gigaam-v3-e2e-ctc", "gigaam_v3_e2e_ctc", "tone", "vosk", "vosk_small", "parakeet_v2", "parakeet_v3", "canary",
    "whisper_base", "whisper_turbo",
)
TEXT_SUFFIXES = ("_txt", "_text", "_transcript")
TIME_SUFFIXES = ("_tst", "_timestamps")
DERIVED = ("accent", "rover", "punct", "phonemes")
CONSISTENCY = "asr_consistency_percent"


def model_suffix(model: str) -> str:
    """A model's sidecar name; all models of one family share theirs."""
    return "vosk" if "vosk" in model else model


def suffixes(models: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(model_suffix(m) for m in models))


def sidecar_kinds(models: Sequence[str]) -> list[str]:
    """All sidecar kinds that a collated table has."""
    own = suffixes(models)
    return list(dict.fromkeys([*DERIVED, *own, *[f"{s}_timestamps" for s in own]]))


def drop_text(df: DataFrame, models: Sequence[str] = (), times: bool = True) -> DataFrame:
    """df without text columns; times: without time columns too."""
    named = {*TEXT_COLUMNS, *sidecar_kinds(models)} if models else {*TEXT_COLUMNS}
    ends = TEXT_SUFFIXES + (TIME_SUFFIXES if times else ())
    if not times:
        named = {n for n in named if not n.endswith(TIME_SUFFIXES)}
    return df.drop(*[c for c in df.columns if c.lower() in named or c.lower().endswith(ends)])


def pivot(sidecars: DataFrame, kinds: Sequence[str], key: str = "filepath", kind: str = "kind", text: str = "text") -> DataFrame:
    """A row a clip with a column a kind; the kinds are given, so one aggregation does it."""
    # dealt by clip first, so texts are sorted once, after the shuffle, and not before it too
    return sidecars.where(F.col(kind).isin(*kinds)).select(key, kind, text).repartition(key).groupBy(key).agg(*[F.max(F.when(F.col(kind) == k, F.col(text))).alias(k) for k in kinds])


def collate(manifest: DataFrame, sidecars: DataFrame, models: Sequence[str], key: str = "filepath") -> DataFrame:
    """The manifest without its old text columns, with all sidecars (missing ones empty) and the transcripts' agreement."""
    kinds = sidecar_kinds(models)
    wide = pivot(sidecars, kinds, key).withColumnRenamed(key, "__key")
    base = drop_text(manifest, models).drop(CONSISTENCY)
    out = base.join(wide, base[key] == F.col("__key"), "left").drop("__key")
    out = out.withColumns({k: F.coalesce(F.col(f"`{k}`"), F.lit("")) for k in kinds})
    return out.withColumn(CONSISTENCY, agreement(suffixes(models)))


def siblings(clips: DataFrame, files: DataFrame) -> DataFrame:
    """(filepath, parts map<string,string>): each clip's sibling texts by what follows its stem.

    clips: (filepath, dir, stem); files: (dir, name, text). A file offers every stem that its name could have (what stands before a "_" or a
    "."), so folder and stem meet by an equi-join; another clip's longer stem is never taken for a kind.
    """
    offers = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1))), lambda i: F.when(F.substr("name", i, F.lit(1)).isin("_", "."), F.substr(F.col("name"), F.lit(1), i - 1))), lambda x: x.isNotNull() & (x != ""))
    offered = files.select(F.col("dir").alias("__dir"), "name", "text", F.explode(offers).alias("__stem"))
    joined = clips.join(offered, (clips["dir"] == F.col("__dir")) & (clips["stem"] == F.col("__stem")))
    # the clip with the longest stem owns the file
    own = joined.groupBy("__dir", "name").agg(F.max_by(F.struct("filepath", "__stem", "text"), F.length("__stem")).alias("x"))
    kind = F.regexp_replace(F.expr("substring(name, length(x.__stem) + 1)"), r"^[_.]", "")
    return own.groupBy(F.col("x.filepath").alias("filepath")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind.alias("k"), F.col("x.text").alias("v"))))).alias("parts"))
