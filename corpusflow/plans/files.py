"""Queries that write the given tables as files, and what operators over files make of them; each beside its SQL.

Files lie below a new folder of the shared one. Text sidecars and WAV files are made of documents and vectors, a file a row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import collate, filters, manifest, partitioning, report, scorers
from ..sinks import files, partials, records
from ..sinks.scratch import materialise, shared_dir
from ..sources import audio, lengths
from ..sources import manifest as stored
from .common import audit_log, table
from .queries import query


def _root(spark) -> str:
    return f"{shared_dir(spark)}/f-{uuid.uuid4().hex}"


def _written(df: DataFrame, root: str, name: str = "name", content: str = "content") -> None:
    files.write_binaries(df, root, name, content).write.format("noop").mode("overwrite").save()


def _folder(key: str) -> Column:
    """One of 256 folders, so that none has all files."""
    return F.concat(F.pmod(F.col(key), F.lit(256)).cast("string"), F.lit("/"))


def _texts(spark, d, root: str) -> None:
    """Of every conversation a text file a turn: `<folder>/<conv_id>_vosk.txt` for the first, `<folder>/<conv_id>_t<turn>.txt` for others."""
    c = table(spark, d, "conversations").where("text is not null")
    name = F.concat(_folder("conv_id"), F.col("conv_id").cast("string"), F.when(F.col("turn") == 0, F.lit("_vosk.txt")).otherwise(F.concat(F.lit("_t"), F.col("turn").cast("string"), F.lit(".txt"))))
    _written(c.select(name.alias("name"), F.encode("text", "utf-8").alias("content")), root)


def _sounds(spark, d, root: str) -> DataFrame:
    """Vectors as WAV files; (vec_id, label, name)."""
    e = table(spark, d, "embeddings").where("embedding is not null")
    e = e.select("vec_id", "label", F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("name"), F.col("embedding").cast("array<double>").alias("x"))
    _written(scorers.scored(e, scorers.FunctionScorer("content binary", lambda: None, files.as_wav), "name", "x").select("name", "content"), root)
    return e.drop("x")


@query("""
select conv_id, turn, sha256(text) digest from conversations where text is not null and turn > 0
""")
def sidecar_scan(spark, d):
    """Text files below a folder whose names end alike; files that end otherwise are left out."""
    root = _root(spark)
    _texts(spark, d, root)
    t = audio.text_files(spark, root, "_t*.txt")
    stem = paths.stem(F.col("path"))
    return t.select(F.split_part(stem, F.lit("_t"), F.lit(1)).cast("long").alias("conv_id"), F.split_part(stem, F.lit("_t"), F.lit(2)).cast("int").alias("turn"), F.sha2("text", 256).alias("digest"))


@query("""
select doc_id, coalesce(trim(c.text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') vosk from documents left join (select conv_id, text from conversations where turn = 0) c on conv_id = doc_id
""")
def sidecar_read(spark, d):
    """The sidecar of one kind beside each clip, stripped; empty where there is none."""
    root = _root(spark)
    _texts(spark, d, root)
    clips = table(spark, d, "documents").select("doc_id", F.concat(F.regexp_replace(F.lit(root), "^file:/+", "/"), F.lit("/"), _folder("doc_id"), F.col("doc_id").cast("string"), F.lit(".flac")).alias("filepath"))
    return audio.with_sidecar(clips, audio.sidecars(spark, root, ["vosk"]), "vosk").select("doc_id", "vosk")


@query("""
select vec_id, 'csv' way from embeddings where embedding is not null and label < 3 union all select vec_id, 'rglob' from embeddings where embedding is not null union all select vec_id, 'auto' from embeddings where embedding is not null
""")
def discovered_clips(spark, d):
    """A corpus by its manifest, by its files, and by its files where the manifest is empty."""
    root = _root(spark)
    own = _sounds(spark, d, root)
    m = own.where("label < 3").select(F.col("name").alias("filepath"))
    m = m.unionByName(m).unionByName(own.select(F.lit("notes.txt").alias("filepath")))
    found = [audio.discover(spark, root, m, "CSV").withColumn("way", F.lit("csv")), audio.discover(spark, root, m, "file-system").withColumn("way", F.lit("rglob")), audio.discover(spark, root, m.limit(0)).withColumn("way", F.lit("auto"))]
    return found[0].unionByName(found[1]).unionByName(found[2]).select(F.regexp_extract("filepath", r"v(\d+)\.wav$", 1).cast("long").alias("vec_id"), "way")


@query("""
select count(*)::bigint pending, count(*)::bigint after_compaction from (select conv_id from conversations union all select conv_id from conversations where turn = 0)
""")
def pending_partial_rows(spark, d):
    """Rows that wait in partial tables: headers don't count, compaction changes nothing."""
    root, c = _root(spark), table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("filepath"), "role", "turn")
    partials.append(c, root)
    partials.append(c.where("turn = 0"), root)
    before = stored.pending_rows(spark, f"{root}/p*")
    partials.compact(spark, root, fan=2)
    return spark.range(1).select(F.lit(before).cast("long").alias("pending"), F.lit(partials.rows(spark, root)).cast("long").alias("after_compaction"))


@query("""
select vec_id, case when label % 2 = 0 then vec_id + 0.5 else 0.004 end::double total_duration from embeddings where embedding is not null
""")
def ensured_durations(spark, d):
    """Durations from the manifest where it has any above 0, else from the files' headers (64 samples at 16 kHz)."""
    root = _root(spark)
    own = _sounds(spark, d, root)
    path = F.concat(F.regexp_replace(F.lit(root), "^file:/+", "/"), F.lit("/"), F.col("name"))
    clips = materialise(own.select("vec_id", "label", path.alias("filepath")))
    known = clips.select("filepath", F.when(F.col("label") % 2 == 0, F.col("vec_id") + 0.5).otherwise(F.when(F.col("label") == 1, 0.0)).alias("total_duration"))
    out = audio.ensure_durations(clips, known, audio.listing(spark, root))
    return out.join(clips, "filepath").select("vec_id", "total_duration")


@query("""
select vec_id from embeddings where embedding is not null and not (label between 3 and 6)
""")
def deleted_files(spark, d):
    """Flagged files go, in the tasks; what is left is listed again, and the manifest pruned by it."""
    root = _root(spark)
    own = _sounds(spark, d, root)
    m = materialise(own.select("vec_id", F.concat(F.regexp_replace(F.lit(root), "^file:/+", "/"), F.lit("/"), F.col("name")).alias("filepath"), F.col("label").between(3, 6).alias("deleted")))
    files.delete_flagged(spark, m, confirmed=True)
    return manifest.prune_missing(m, audio.listing(spark, root)).select("vec_id")


@query("""
select conv_id, case when conv_id % 3 = 0 then 'vosk' when conv_id % 3 = 1 then 'tone' else 'vosk' end suffix, count(*)::int n from conversations group by conv_id
""")
def model_suffixes(spark, d):
    """Models of one family share a sidecar: three models' texts land in two columns of kinds."""
    models = ["vosk_small", "tone", "vosk"]
    kinds = F.create_map(*[F.lit(x) for m in models for x in (m, collate.model_suffix(m))])
    c = table(spark, d, "conversations").withColumn("model", F.get(F.array(*[F.lit(m) for m in models]), F.col("conv_id") % 3))
    return c.groupBy("conv_id", kinds[F.col("model")].alias("suffix")).agg(F.count("*").cast("int").alias("n"))


@query("""
select event_id, value > 50 given, value > 20 configured from events where value is not null
""")
def resolved_thresholds(spark, d):
    """A threshold given on the command line counts before the configured one."""
    e = table(spark, d, "events").where("value is not null")
    given, configured = filters.resolve_threshold(50.0, 20.0), filters.resolve_threshold(None, 20.0)
    return e.select("event_id", (F.col("value") > given).alias("given"), (F.col("value") > configured).alias("configured"))


@query("""
select event_type, count(*)::bigint files_in, count(*) filter (where not coalesce(value > 10, false))::bigint files_out, count(distinct user_id % 8)::bigint workers from events group by event_type
""")
def merged_counters(spark, d):
    """Audits of eight workers, a table each, added up by stage."""
    e = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("crest_factor"), F.lit(1.0).alias("total_duration"), (F.col("user_id") % 8).alias("worker"))
    flagged = filters.crest_filter(e, threshold=10.0).withColumn("stage", F.concat_ws("/", "stage", "worker"))
    own = filters.audit(flagged, "total_duration", "deleted", "stage").withColumn("event_type", F.split_part("stage", F.lit("/"), F.lit(1)))
    return own.groupBy("event_type").agg(F.sum("files_in").alias("files_in"), F.sum("files_out").alias("files_out"), F.count("*").alias("workers"))


@query("""
with p as (select lower(regexp_extract(o_orderpriority, '^\\d+-(.*)$', 1)) stage from orders group by 1) select count(*)::bigint stages, count(*)::bigint rows_told, true net_told from p
""")
def markdown_report(spark, d):
    """The reduction report has a row for each stage and a net line."""
    log = audit_log(spark, d).withColumn("params", F.lit("{}"))
    text = records.markdown(log)
    lines = spark.createDataFrame([(x,) for x in text.splitlines()], "line string")
    stages = report.stage_report(log).agg(F.count("*").alias("stages"))
    told = lines.agg(F.count_if(F.col("line").rlike(r"^\| (?!Stage)[^-]")).alias("rows_told"), F.max(F.col("line").startswith("Net: ")).alias("net_told"))
    return stages.crossJoin(told)


@query("""
select o_orderkey, o_totalprice::double total_duration from orders
""")
def length_ranges(spark, d):
    """Work in ranges of similar length, each sorted inside: no range begins before the one before has ended."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("total_duration"))
    own = materialise(partitioning.by_length(o, "total_duration", 6).withColumn("range", F.spark_partition_id()))
    edges = own.groupBy("range").agg(F.min("total_duration").alias("lo"), F.max("total_duration").alias("hi"))
    later = edges.select(F.col("range").alias("next"), F.col("lo").alias("next_lo"))
    over = edges.join(later, (F.col("range") < F.col("next")) & (F.col("hi") > F.col("next_lo"))).count()  # of six ranges
    return own.where(F.lit(over == 0)).select("o_orderkey", "total_duration")


@query("""
select step, doc_id filepath, n_chars::double duration, case step when 0 then 'rebuild' when 1 then 'hit' when 2 then 'append' when 3 then 'superset' else 'rebuild' end found
from documents, (select unnest(range(5)) step) where case step when 0 then doc_id % 3 <> 0 when 1 then doc_id % 3 <> 0 when 2 then true when 3 then doc_id % 3 <> 0 else doc_id % 4 = 0 end
""")
def cached_lengths(spark, d):
    """Lengths through the cache: built, hit, appended to, asked for what it had before, and rebuilt after clips are gone."""
    root, c = _root(spark), table(spark, d, "documents").select(F.col("doc_id").alias("filepath"), F.col("n_chars").cast("double").alias("duration"))
    probe = lambda new: new.join(c.withColumnRenamed("filepath", "__f"), F.col("filepath") == F.col("__f")).select("filepath", "duration")
    some = c.where("filepath % 3 <> 0")
    out = []
    for step, own in enumerate((some, some.orderBy(F.desc("filepath")), c, some, c.where("filepath % 4 = 0"))):
        rows, found = lengths.lengths(own, root, probe)
        out.append(rows.withColumns({"step": F.lit(step).cast("long"), "found": F.lit(found)}))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]).unionByName(out[4]).select("step", "filepath", "duration", "found")


#: Queries whose files are opaque to the JVM.
PYTHON = {"sidecar_scan", "sidecar_read", "discovered_clips", "ensured_durations", "deleted_files"}
