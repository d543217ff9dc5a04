"""Command line: reports and profiles of a manifest, without a notebook.

    python -m corpusflow report AUDIT [--missing MANIFEST]
    python -m corpusflow profile MANIFEST OUT
    python -m corpusflow filter MANIFEST OUT --score crest_factor --threshold 10 --side above
"""

from __future__ import annotations

import argparse


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--master", help="Spark master; the cluster's own otherwise")
    sub = parser.add_subparsers(dest="what", required=True)
    p = sub.add_parser("report", help="reduction report as Markdown")
    p.add_argument("audit")
    p.add_argument("--missing", help="a manifest whose missing values are reported")
    p = sub.add_parser("profile", help="summaries, quantiles, correlations and missing values as tables")
    p.add_argument("manifest")
    p.add_argument("out")
    p = sub.add_parser("filter", help="flag rows by a threshold and print the audit")
    p.add_argument("manifest")
    p.add_argument("out")
    p.add_argument("--score", required=True)
    p.add_argument("--threshold", type=float, required=True)
    p.add_argument("--side", choices=("above", "below"), default="above")
    p.add_argument("--duration", default="total_duration")
    a = parser.parse_args(args)

    from pyspark.sql import functions as F

    from .operators import filters, profile, report
    from .session import session
    from .sinks import records
    from .sources import manifest

    spark = session(a.master)
    if a.what == "report":
        print(records.markdown(manifest.audit_log(spark, a.audit), report.missing(spark.read.parquet(a.missing)) if a.missing else None), end="")
    elif a.what == "profile":
        df = profile.durations(manifest.conformed(spark.read.parquet(a.manifest)))
        metrics = profile.metric_columns(df)
        tables = {"describe": profile.describe(df, metrics), "summary": profile.core_summary(df, metrics), "quantiles": profile.quantile_grid(df, metrics), "correlations": profile.correlations(df, metrics), "missing": report.missing(df, distinct=True)}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{a.out}/{name}")
    else:
        df = spark.read.parquet(a.manifest)
        flagged = df.withColumn("deleted", filters.deleted_by(F.col(a.score), a.threshold, a.side))
        flagged.write.mode("overwrite").parquet(a.out)
        print(filters.audit(spark.read.parquet(a.out), a.duration).first().asDict())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
