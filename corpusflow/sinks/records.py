"""Records of runs: audit rows, stage status, sidecars, JSON lines, reports."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import real_time
from ..operators.report import net_effect, report_lines, stage_report
from .versions import _fs

ERROR_DETAILS = 50


def now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")


def json_params(**params: Column) -> Column:
    """Columns as one JSON text with ordered keys, a space after each colon and comma; null values stay null there."""
    value = lambda c: F.regexp_extract(F.to_json(F.array(c), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1)
    pairs = [F.concat(F.lit(json.dumps(k) + ": "), value(c)) for k, c in sorted(params.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def append_audits(counts: DataFrame, path: str) -> None:
    """Append an audit row for each row of counts: stage, files and hours, params as JSON, sequence; all in one write."""
    rows = counts.select(
        F.lit(now()).alias("timestamp"), "stage", *[F.col(c).cast("long") for c in ("files_in", "files_out")],
        *[F.bround(F.col(c).cast("double"), 4).alias(c) for c in ("hours_in", "hours_out")], F.bround(F.greatest(F.col("hours_in") - F.col("hours_out"), F.lit(0.0)), 4).alias("hours_removed"),
        "params", F.col("sequence").cast("long").alias("sequence"),
    )
    rows.write.mode("append").parquet(path)


def append_audit(spark: SparkSession, path: str, stage: str, counts: DataFrame, params: dict, sequence: int) -> None:
    """Append an audit row: counts is one row of files and hours; params are JSON with ordered keys."""
    row = counts.select(
        F.lit(stage).alias("stage"), *[F.col(c) for c in ("files_in", "files_out", "hours_in", "hours_out")],
        F.lit(json.dumps(params, sort_keys=True, ensure_ascii=False)).alias("params"), F.lit(sequence).alias("sequence"),
    )
    append_audits(row.coalesce(1), path)


def put_text(path: str, text: str) -> None:
    """Write a small text where Spark writes tables; readers see the old one or the new one whole."""
    spark = SparkSession.active()
    fs, make = _fs(spark, path)
    part = make(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(make(path)):
        fs.delete(make(path), False)
    if not fs.rename(part, make(path)):
        raise OSError(f"{path} could not be written")


def write_status(folder: str, stage: str, total: int, errors: list[dict]) -> dict:
    """The status of a finished stage; at most 50 errors in detail, all of them counted."""
    status = {"stage": stage, "finished_at": now(), "total": total, "errors": len(errors), "error_details": errors[:ERROR_DETAILS]}
    put_text(f"{folder}/stage_{stage}_status.json", json.dumps(status, ensure_ascii=False, indent=2))
    return status


def append_sidecars(texts: DataFrame, path: str, kind: str) -> None:
    """Append (filepath, kind, text); a null text leaves what is there, the last row of a clip counts."""
    texts.where("text is not null").select("filepath", F.lit(kind).alias("kind"), "text").write.mode("append").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def benchmark_report(repeats: DataFrame, path: str) -> dict:
    """The report of a benchmark's repeats (target, repeat, samples, wall_s, audio_s, error) as JSON: for each target its runs, failures, and avg, max
    and min of the real-time factor and its inverse over the runs that worked. All targets are reported; their rows, which are
    the report, come to the driver partition by partition."""
    own = real_time(repeats, "wall_s", "audio_s").withColumn("ok", F.col("error").isNull())
    rows = own.groupBy("target").agg(
        F.count("*").alias("repeats"), F.count_if(~F.col("ok")).alias("failed"), F.max("samples").alias("samples"),
        *[f(F.when(F.col("ok"), F.col(c))).alias(f"{c}_{n}") for c in ("rtf", "x_realtime") for n, f in (("avg", F.avg), ("max", F.max), ("min", F.min))],
    )
    report = {"finished_at": now(), "targets": [r.asDict() for r in rows.orderBy("target").toLocalIterator()]}
    put_text(path, json.dumps(report, ensure_ascii=False, indent=2))
    return report


def markdown(audit: DataFrame, missing: DataFrame | None = None) -> str:
    """The reduction report as Markdown: all stages and columns; their rows, which are the report, come to the driver partition by partition."""
    r = stage_report(audit)
    out = ["# Reduction report", "", "| Stage | Files in | Files out | Hours in | Hours out | Removed | Parameters |", "|-|-|-|-|-|-|-|"]
    out += [x["line"] for x in report_lines(r).orderBy("rank", "stage").toLocalIterator()]
    net = net_effect(r).first()
    if net["stages"]:
        out += ["", f"Net: {net['first_in']:.2f}h in, {net['last_out']:.2f}h out, {net['net_percent']:.1f}% removed."]
    if missing is not None:
        out += ["", "| Column | Missing | % |", "|-|-|-|"]
        out += [f"| {x['column']} | {x['missing']} | {x['missing_percent']:.3f} |" for x in missing.orderBy(F.desc("missing"), "column").toLocalIterator()]
    return "\n".join(out) + "\n"
