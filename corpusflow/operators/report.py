"""Reduction reports from the audit log, and missing-value tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.text import is_missing
from .manifest import latest

# Stages in the order of a report.
STAGE_ORDER = (
    "preprocess", "crest_factor", "music_detect", "distillmos", "distillmos_filter", "antispoofing_filter", "transcription",
    "punctuation", "accents", "phonemizer", "export",
)


def stage_rank(stage: Column, order: Sequence[str] = STAGE_ORDER) -> Column:
    """Place of a stage; unknown ones after all known."""
    at = F.array_position(F.array(*[F.lit(s) for s in order]), stage)
    return F.when(at > 0, at).otherwise(len(order) + 1).cast("int")


def stage_report(audit: DataFrame, order: Sequence[str] = STAGE_ORDER) -> DataFrame:
    """The latest run of each stage with what it removed in percent; `sequence` breaks ties of the timestamp."""
    runs = latest(audit, "stage", "timestamp", "sequence")
    removed = F.greatest(F.col("hours_in") - F.col("hours_out"), F.lit(0.0))
    return runs.withColumns({"rank": stage_rank(F.col("stage"), order), "removed_percent": F.round(percent(removed, F.col("hours_in")), 3)})


def net_effect(report: DataFrame) -> DataFrame:
    """First stage's input against the last one's output."""
    at = F.struct("rank", "stage")
    net = report.agg(F.min_by("hours_in", at).alias("first_in"), F.max_by("hours_out", at).alias("last_out"), F.min_by("files_in", at).alias("files_first"), F.max_by("files_out", at).alias("files_last"), F.count("*").alias("stages"))
    removed = F.greatest(F.col("first_in") - F.col("last_out"), F.lit(0.0))
    return net.withColumns({"net_removed": removed, "net_percent": F.round(percent(removed, F.col("first_in")), 3)})


def missing(df: DataFrame, blank: bool = True, distinct: bool = False) -> DataFrame:
    """(column, missing, percent, dtype[, n_unique]): one aggregation over all columns, then a row for each."""
    aggs, kinds = [F.count("*").alias("__rows")], dict(df.dtypes)
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        gone = is_missing(col) if kinds[c] == "string" and blank else (col == "") | col.isNull() if kinds[c] == "string" else col.isNull()
        if kinds[c] in ("double", "float"):
            gone = gone | F.isnan(col)
        aggs.append(F.count_if(gone).alias(f"m{i}"))
        if distinct:
            aggs.append(F.count_distinct(col).alias(f"d{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"m{i}").alias("missing"), *([F.col(f"d{i}").alias("n_unique")] if distinct else [])) for i, c in enumerate(df.columns)])
    each = one.select("__rows", F.explode(rows).alias("x")).select("__rows", "x.*")
    return each.withColumn("missing_percent", F.round(percent(F.col("missing"), F.col("__rows")), 3)).drop("__rows")


def hours_text(hours: Column) -> Column:
    """12.34h (12h 20m)."""
    minutes = F.round(hours * 60).cast("long")
    return F.format_string("%.2fh (%dh %dm)", hours, F.floor(minutes / 60).cast("long"), F.pmod(minutes, F.lit(60)))


def params_text(params: Column) -> Column:
    """`key=value` pairs of a JSON object; other text as it is."""
    m = F.from_json(params, "map<string,string>")
    pairs = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(F.lit("`"), e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None")), F.lit("`")))
    return F.when(m.isNull() | (F.size(m) == 0), F.coalesce(params, F.lit(""))).otherwise(F.array_join(pairs, ", "))


def report_lines(report: DataFrame) -> DataFrame:
    """(rank, line): a Markdown table row for each stage."""
    line = F.format_string("| %s | %d | %d | %s | %s | %.1f%% | %s |", F.col("stage"), F.col("files_in"), F.col("files_out"), hours_text(F.col("hours_in")), hours_text(F.col("hours_out")), F.col("removed_percent"), params_text(F.col("params")))
    return report.select("rank", "stage", line.alias("line"))
