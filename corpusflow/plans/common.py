"""Driver tables as the engine's inputs: clips, segments, candidates, audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros() -> Column:
    """Microseconds of events.ts since 2024 began."""
    return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")  # whatever the session's zone is


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as segments: a user is a source, 30 days are folded 500 times, the value is the length, the type names speaker and prediction."""
    e = table(spark, sf_dir, "events")
    start = F.floor(micros() / 500) / 1e6
    return e.select(
        F.col("user_id").alias("source_id"), F.col("event_id").cast("int").alias("pos"), start.alias("seg_start"), (start + F.col("value")).alias("seg_end"),
        F.when(F.col("event_type").isin("view", "click"), 0).when(F.col("event_type") == "error", 1).otherwise(2).alias("speaker"),
        F.when(F.col("event_type").isin("purchase", "view"), 1).otherwise(0).alias("prediction"),
    )


#: segments() in SQL.
SEGMENTS_SQL = """
  select user_id source_id, cast(event_id as int) pos, s seg_start, s + value seg_end,
    case when event_type in ('view', 'click') then 0 when event_type = 'error' then 1 else 2 end speaker,
    case when event_type in ('purchase', 'view') then 1 else 0 end prediction
  from (select *, ((epoch_us(ts) - 1704067200000000) // 500) / 1e6 s from events)
"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models' transcripts of each document side by side: its text, the text in lower case with wide spaces, and a text that loses its first word in two of three."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("filepath"), F.col("text").alias("t"))
    lost = F.when(F.col("filepath") % 3 == 0, F.col("t")).otherwise(F.regexp_replace("t", r"^[^ ]* ", ""))
    return d.select("filepath", F.col("t").alias("a"), F.lower(F.replace("t", F.lit(" "), F.lit("  "))).alias("b"), lost.alias("c"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, a row a transcript."""
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("text")) for m in ("a", "b", "c")])
    return transcripts(spark, sf_dir).select("filepath", F.explode(models).alias("x")).select("filepath", "x.model", "x.text")


#: candidates() in SQL.
CANDIDATES_SQL = """
  select filepath, unnest(['a', 'b', 'c']) model, unnest([t, lower(replace(t, ' ', '  ')), case when filepath % 3 = 0 then t else regexp_replace(t, '^[^ ]* ', '') end]) text
  from (select doc_id filepath, text t from documents)
"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as clips: the length in characters is the duration in seconds."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("filepath"), F.col("n_chars").cast("double").alias("total_duration"), "lang", "source")


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as audit rows: a priority is a stage, a price gives hours, a day is the timestamp, the key breaks ties."""
    o = table(spark, sf_dir, "orders")
    hours = F.floor("o_totalprice") / 1000
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lower(F.regexp_extract("o_orderpriority", r"^\d+-(.*)$", 1)).alias("stage"), F.col("o_custkey").alias("files_in"),
        F.floor(F.col("o_custkey") / 2).alias("files_out"), hours.alias("hours_in"), (hours * (1 - F.pmod("o_orderkey", F.lit(50)) / 100)).alias("hours_out"), F.col("o_orderkey").alias("sequence"),
    )


AUDIT_SQL = """
  select strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') "timestamp", lower(regexp_extract(o_orderpriority, '^\\d+-(.*)$', 1)) stage, o_custkey files_in, cast(floor(o_custkey / 2) as bigint) files_out,
    floor(o_totalprice) / 1000 hours_in, floor(o_totalprice) / 1000 * (1 - (o_orderkey % 50) / 100) hours_out, o_orderkey sequence
  from orders
"""
