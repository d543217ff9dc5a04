"""Queries of scalar rules, sources, sinks and streams over the driver's tables, each beside its SQL.

Sinks write below a new folder of the shared one, and what they wrote is read back: the query's rows are a round trip.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric, paths, text
from ..operators import cache, collate, consensus, filters, intervals, manifest, partitioning, profile, scorers
from ..schema import conformed
from ..sinks import buckets, files, partials, records, versions
from ..sinks.scratch import materialise, shared_dir
from ..sources import audio, catalogue
from ..sources import manifest as stored
from ..streaming import sources
from ..streaming.absorb import absorb
from ..streaming.ingest import ingest
from .common import clips, segments, table
from .queries import query
from .stages import stages_between


def _root(spark) -> str:
    return f"{shared_dir(spark)}/q-{uuid.uuid4().hex}"


# --- scalar rules ----------------------------------------------------------------------------


@query("""
with w as (select doc_id, i, word, ['O', 'PERIOD', 'COMMA', 'QUESTION', 'NONE'][i % 5 + 1] mark from (select doc_id, unnest(range(0, len(w))) i, unnest(w) word from (select doc_id, string_split(regexp_replace(lower(text), '[\\s\\p{Z}]+', ' ', 'g'), ' ') w from documents where text is not null))),
m as (select unnest(['O', 'PERIOD', 'COMMA', 'QUESTION']) mark, unnest(['', '.', ',', '?']) s)
select doc_id, sha256(trim(coalesce(string_agg(word || s, ' ' order by i), ''))) sentence from w left join m using (mark) group by doc_id
""")
def punct_sentences(spark, d):
    """Whole labelled texts; a word whose label is unknown is left out."""
    words = F.split(F.regexp_replace(F.lower("text"), r"[\s\p{Z}]+", " "), " ")
    marks = F.array(*[F.lit(f"LOWER_{m}") for m in ("O", "PERIOD", "COMMA", "QUESTION", "NONE")])
    x = table(spark, d, "documents").where("text is not null").select("doc_id", words.alias("w"))
    labels = F.transform("w", lambda _, i: F.element_at(marks, F.pmod(i, F.lit(5)) + 1))
    return x.select("doc_id", F.sha2(text.punct_join(F.col("w"), labels), 256).alias("sentence"))


@query("""
select page_id, case when page_id % 3 = 0 then '' when page_id % 3 = 1 then '/abs/' || page_id else '/root/data/' || page_id || '.wav' end full_path, page_id % 2 = 0 chunk,
  'a_b-' || page_id || '_' stage, '/x/' || page_id || '_new_new.ogg' swapped from pages
""")
def path_rules(spark, d):
    n = F.col("page_id").cast("string")
    raw = F.when(F.col("page_id") % 3 == 0, F.lit("  ")).when(F.col("page_id") % 3 == 1, F.concat(F.lit(" /abs/"), n)).otherwise(F.concat(F.lit("./data/"), n, F.lit(".wav ")))
    name = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/q/1.50_2.25_"), n, F.lit("_e.ogg"))).otherwise(F.concat(F.lit("/q/1.5_x_"), n))
    return table(spark, d, "pages").select(
        "page_id", paths.normalise(raw, "/root/").alias("full_path"), paths.is_chunk_name(name).alias("chunk"), paths.stage_dir(F.concat(F.lit("a_b-"), n, F.lit("/"))).alias("stage"),
        paths.replace_in_stem(F.concat(F.lit("/x/"), n, F.lit("_old_old.ogg")), "old", "new").alias("swapped"),
    )


@query("""
select page_id, 'https://h/' || page_id || '/1000x1000' cover, format('{:.3f}\t{:.3f}\t{}', page_id / 8, page_id / 4, 'w' || page_id) line, page_id % 4 in (1, 3) podcast from pages
""")
def link_and_line_texts(spark, d):
    n = F.col("page_id").cast("string")
    title = F.element_at(F.array(*[F.lit(x) for x in ("news", "My PODCAST", "pod cast", "ПОДКАСТ дня")]), (F.col("page_id") % 4 + 1).cast("int"))
    p = table(spark, d, "pages").withColumns({"name": title, "about": F.lit("x")})
    line = text.tsv_line(F.col("page_id") / 8, F.col("page_id") / 4, F.concat(F.lit("w"), n))
    return p.select("page_id", paths.cover_url(F.concat(F.lit("h/"), n, F.lit("/%%"))).alias("cover"), line.alias("line"), catalogue.is_podcast("name", "about").alias("podcast"))


@query("""
select user_id, event_id::int pos, event_id / 4 seg_start, event_id / 4 + 1.5 seg_end, (event_id % 3)::int speaker from events where event_id % 5 <> 0
""")
def parsed_segments(spark, d):
    """Segment texts; what doesn't parse or ends before it starts is left out."""
    s = F.col("event_id") / 4
    good = F.concat_ws("  ", s.cast("string"), (s + 1.5).cast("string"), F.concat(F.lit("speaker_"), (F.col("event_id") % 3).cast("string")))
    raw = F.when(F.col("event_id") % 10 == 0, F.lit("nonsense")).when(F.col("event_id") % 5 == 0, F.concat_ws(" ", s.cast("string"), s.cast("string"), F.lit("speaker_1"))).otherwise(good)
    e = table(spark, d, "events").select("user_id", "event_id", F.array(raw).alias("raw"))
    out = intervals.parse_segments(e.withColumn("source", F.struct("user_id", "event_id")), "source", "raw")
    return out.select("source.user_id", F.col("source.event_id").cast("int").alias("pos"), "seg_start", "seg_end", "speaker")


@query("""
select 'c' || doc_id || case when doc_id % 4 = 0 then '_phones' else '' end filepath, lang model, text from documents where lang in ('en', 'de') and doc_id % 4 <> 1
""")
def candidate_texts(spark, d):
    """Derived texts and other kinds are no candidates."""
    tail = F.when(F.col("doc_id") % 4 == 0, F.lit("_phones")).when(F.col("doc_id") % 4 == 1, F.lit("_rover")).otherwise("")
    s = table(spark, d, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string"), tail).alias("filepath"), F.col("lang").alias("kind"), "text")
    return consensus.text_candidates(s, ["en", "de"])


@query("""
select case when o_custkey % 5 = 0 then '' || o_orderkey else o_orderkey || ':' || o_custkey end audio_id, '' || o_orderkey track_id, case when o_custkey % 5 = 0 then '' else '' || o_custkey end album_id, o_orderpriority title,
  o_orderstatus || ', x' artists, (o_orderkey * 10)::bigint duration_ms, 'al' album_title, case when o_orderkey % 2 = 0 then 'u' || o_orderkey else 'https://a/track/' || o_orderkey end track_url from orders
""")
def track_rows(spark, d):
    n, album = F.col("o_orderkey").cast("string"), F.when(F.col("o_custkey") % 5 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string"))
    o = table(spark, d, "orders").select(
        n.alias("track_id"), F.struct(album.alias("id"), F.lit("al").alias("title"), F.lit("https://a").alias("url")).alias("album"), F.col("o_orderpriority").alias("title"),
        F.array("o_orderstatus", F.lit("x")).alias("artists"), (F.col("o_orderkey") * 10).cast("long").alias("duration_ms"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("u"), n)).alias("track_url"),
    )
    return catalogue.flatten_tracks(o)


@query("""
select vec_id, round(list_sum(list_transform(embedding[1:40], lambda x: greatest(least(x::double * 100000, 32767), -32768) / 32768)), 6) total from embeddings
""")
def clipped_int16(spark, d):
    x = numeric.from_int16(F.transform(F.col("embedding"), lambda v: v.cast("double") * 100000), 40)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


@query("""
select l_returnflag, l_linestatus, round(avg(l_quantity), 6) quantity, count(*) filter (where l_quantity > 25)::bigint above from lineitem group by 1, 2
""")
def coerced_metrics(spark, d):
    """Numbers that came as text are numbers again; true text stays text."""
    l = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("string").alias("quantity"))  # noqa: E741
    x = profile.coerce_numeric(l)
    (metric,) = profile.metric_columns(x)
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.avg(metric), 6).alias("quantity"), F.count_if(F.col(metric) > 25).alias("above"))


@query("""
select cast(doc_id as varchar) filepath, cast(null as int) speaker_id, n_chars::double total_duration, cast(null as varchar) podcast_id, cast(null as boolean) is_single_speaker, lang from documents
""")
def conformed_columns(spark, d):
    """Manifest columns in their order and types, whatever came; ids are text."""
    x = conformed(clips(spark, d).withColumn("speaker_id", F.lit("none")))
    return x.select("filepath", "speaker_id", "total_duration", "podcast_id", "is_single_speaker", "lang")


@query("""
select event_id, round(value / nullif(event_id % 7, 0), 6) rtf, round((event_id % 7) / nullif(value, 0), 6) x_realtime from events
""")
def real_time_factors(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("value").alias("wall"), (F.col("event_id") % 7).cast("double").alias("audio"))
    return profile.real_time(e, "wall", "audio").select("event_id", F.round("rtf", 6).alias("rtf"), F.round("x_realtime", 6).alias("x_realtime"))


@query("""
select l_orderkey, l_linenumber, l_quantity stage from lineitem where l_quantity between 5 and 11
""")
def stages_in_range(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("stage"))  # noqa: E741
    return stages_between(l, "stage", "5", "11")


@query("""
select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and quality is not null) order by doc_id limit 37
""")
def first_pending(spark, d):
    """A limited run takes the first of what is pending."""
    return manifest.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["quality"], "doc_id").orderBy("doc_id").limit(37)


@query("""
select doc_id filepath, n_chars::double total_duration from documents where n_chars > 0 and doc_id in (select doc_id from labels)
""")
def cached_durations(spark, d):
    return stored.duration_cache(clips(spark, d), table(spark, d, "labels").select(F.col("doc_id").alias("filepath")))


@query("""
select distinct 'a/' || page_id || case when page_id % 3 = 0 then '.WAV' else '.opus' end filepath from pages where page_id % 3 < 2
""")
def audio_paths(spark, d):
    ext = F.element_at(F.array(F.lit(".WAV"), F.lit(".opus"), F.lit(".txt")), (F.col("page_id") % 3 + 1).cast("int"))
    p = table(spark, d, "pages").select(F.concat(F.lit("a/"), F.col("page_id").cast("string"), ext).alias("filepath"))
    return stored.audio_paths(p.union(p))


@query("""
select doc_id, regexp_extract(url, '([^/]*)$', 1) name, lang from (select 'd/' || page_id || '.x' url, page_id from pages) join documents on doc_id = page_id
""")
def lookup_by_stem(spark, d):
    m = stored.metadata_by_stem(clips(spark, d).withColumns({"filepath": F.concat(F.lit("r/"), F.col("filepath").cast("string"), F.lit(".flac")), "id": F.col("filepath")}))
    p = table(spark, d, "pages").select(F.concat(F.lit("d/"), F.col("page_id").cast("string"), F.lit(".x")).alias("url")).withColumn("__stem", paths.stem(F.col("url")))
    return p.join(m, F.col("__stem") == F.col("stem")).select(F.col("id").alias("doc_id"), paths.file_name(F.col("url")).alias("name"), "lang")


@query("""
select 'p' || conv_id filepath, count(*)::int n, string_agg(turn || '=' || text, '|' order by '' || turn) parts from conversations group by conv_id
""")
def sibling_texts(spark, d):
    """All texts whose name begins with a clip's stem, by what follows it."""
    c = table(spark, d, "conversations")
    n = F.concat(F.lit("p"), F.col("conv_id").cast("string"))
    own = c.select(n.alias("filepath"), F.lit("f").alias("dir"), n.alias("stem")).distinct()
    t = c.select(F.lit("f").alias("dir"), F.concat(n, F.when(F.col("turn") % 2 == 0, "_").otherwise("."), F.col("turn").cast("string")).alias("name"), "text")
    entries = F.transform(F.array_sort(F.map_entries("parts")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return collate.siblings(own, t).select("filepath", F.size("parts").alias("n"), F.array_join(entries, "|").alias("parts"))


@query("""
select doc_id, ((row_number() over (order by doc_id) - 1) % 7)::bigint strided, ntile(7) over (order by doc_id) - 1 contiguous from documents
""")
def worker_splits(spark, d):
    x = table(spark, d, "documents").select("doc_id")
    a, b = partitioning.strided(x, "doc_id", 7).withColumnRenamed("worker", "strided"), partitioning.contiguous(x, "doc_id", 7).withColumnRenamed("worker", "contiguous")
    return a.join(b, "doc_id").select("doc_id", F.col("strided").cast("long").alias("strided"), F.col("contiguous").cast("long").alias("contiguous"))


@query("""
with o as (select o_custkey, count(*) n, sum(o_orderkey) t from orders group by 1), b as (select *, ((row_number() over (order by o_custkey) - 1) // 16)::bigint batch from o)
select o_custkey, batch, max(n) over (partition by batch)::int length, t::double total from b
""")
def padded_batches(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.col("o_orderkey").cast("double")).alias("x"))
    p = partitioning.padded(o, "o_custkey", "x", 16)
    return p.select("o_custkey", F.col("batch").cast("long").alias("batch"), F.size("x").alias("length"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("total"))


@query("""
select user_id, count(*)::bigint n, round(quantile_cont(value, 0.1), 6) p10, round(quantile_cont(value, 0.5), 6) p50, round(quantile_cont(value, 0.99), 6) p99 from events where value is not null group by 1
""")
def ranked_percentiles(spark, d):
    """Percentiles by brackets from sketches, the way that no task sees a whole group and few rows are sent."""
    e = table(spark, d, "events").where("value is not null").select("user_id", "value")
    q = partitioning.percentiles(e, ["user_id"], "value", [0.1, 0.5, 0.99], most=0, group_rows=0, accuracy=20)
    n = e.groupBy("user_id").agg(F.count("*").alias("n"))
    return n.join(q, "user_id").select("user_id", "n", *[F.round(F.get("q", F.lit(i)), 6).alias(f"p{p}") for i, p in enumerate((10, 50, 99))])


@query("""
with n as (select 'l_suppkey' "column", coalesce(cast(l_suppkey as varchar), '<NA>') "value", count(*) n from lineitem group by 2 union all select 'l_returnflag', coalesce(l_returnflag, '<NA>'), count(*) from lineitem group by 2
    union all select 'l_orderkey', coalesce(cast(l_orderkey as varchar), '<NA>'), count(*) from lineitem group by 2),
  r as (select *, row_number() over (partition by "column" order by n desc, "value") "rank", sum(n) over (partition by "column") t from n)
select "column", "value", n, round(n * 100.0 / t, 3)::double "percent", "rank" from r where "rank" <= 20
""")
def frequent_values(spark, d):
    """Most common values by sketches of frequent ones and an exact recount: few values, many, and a key, for which all are counted."""
    return profile.categories(table(spark, d, "lineitem"), ["l_suppkey", "l_returnflag", "l_orderkey"], top=20, most=0, tracked=3000)


@query("""
with e as (select vec_id, unnest(range(64)) i, unnest(embedding)::double v from embeddings where embedding is not null and len(embedding) = 64),
  f as (select * from e where (vec_id + i) % 11 <> 0)
select 'e' || a.i metric_a, 'e' || b.i metric_b, round(corr(a.v, b.v), 5) corr from f a join f b using (vec_id) group by 1, 2
""")
def wide_correlations(spark, d):
    """Vectors' 64 numbers as metrics, one in eleven of which is missing: 4,096 correlations from sums of blocks."""
    e = table(spark, d, "embeddings").where("embedding is not null and size(embedding) = 64")
    own = e.select(*[F.when((F.col("vec_id") + i) % 11 != 0, F.get("embedding", F.lit(i)).cast("double")).alias(f"e{i}") for i in range(64)])
    return profile.correlations(own, own.columns, 5)


@query("""
select path, duration from (select 'b/' || doc_id path, n_chars::double duration, doc_id from documents) where duration > 500 and doc_id in (select doc_id from labels) order by path limit 25
""")
def benchmark_clips(spark, d):
    f = table(spark, d, "documents").select(F.concat(F.lit("b/"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").cast("double").alias("duration"))
    side = table(spark, d, "labels").select(F.concat(F.lit("b/"), F.col("doc_id").cast("string")).alias("stem_path"), F.lit("rover").alias("kind"), F.lit("t").alias("text"))
    return audio.benchmark_sample(f, side, ["rover"], 500.0, 25)


# --- sinks and sources: round trips ----------------------------------------------------------


def _manifest(spark, d) -> DataFrame:
    return conformed(clips(spark, d).withColumn("crest_factor", F.col("total_duration") / 10)).select("filepath", "total_duration", "crest_factor", "lang")


@query("""
select cast(doc_id as varchar) filepath, n_chars::double total_duration, case when doc_id % 2 = 0 then 1.5 else n_chars / 10 end::double crest_factor from documents
""")
def committed_versions(spark, d):
    """Two commits of a manifest; the last one is read."""
    root, m = _root(spark), _manifest(spark, d)
    versions.commit(m, root)
    new = F.when(F.col("filepath").cast("long") % 2 == 0, F.lit(1.5)).otherwise(F.col("crest_factor"))
    versions.commit(stored.load(spark, root).withColumn("crest_factor", new), root)
    return stored.load_or_previous(spark, root).select("filepath", "total_duration", "crest_factor")


@query("""
select cast(doc_id as varchar) filepath, case when doc_id % 3 = 0 then n_chars + 1 else n_chars end::varchar score, case when doc_id % 3 = 0 then lang end note from documents
""")
def appended_partials(spark, d):
    """Partial tables of two runs, the second with a column more; of a clip's rows the last counts."""
    root, c = _root(spark), table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("filepath"), F.col("n_chars").alias("score"), "lang")
    partials.append(c.select("filepath", "score"), root)
    again = c.where("cast(filepath as long) % 3 = 0").select("filepath", (F.col("score") + 1).alias("score"), F.col("lang").alias("note"))
    partials.append(again, root)
    return partials.merged(spark, root).select("filepath", "score", "note")


@query("""
select cast(doc_id as varchar) filepath, (n_chars + doc_id % 40)::varchar score, case when doc_id % 40 >= 20 then lang end note from documents
""")
def compacted_partials(spark, d):
    """Forty runs, of which each clip is in two; they are compacted in levels, two later runs lie beside them."""
    root, c = _root(spark), table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("filepath"), "doc_id", F.col("n_chars").alias("score"), "lang")
    partials.append(c.select("filepath", "score"), root)
    for i in range(40):
        own = c.where(F.col("doc_id") % 40 == i).select("filepath", (F.col("score") + i).alias("score"), *([F.col("lang").alias("note")] if i >= 20 else []))
        partials.append(own, root)
        if i == 37:
            partials.compact(spark, root, fan=6)
    return partials.merged(spark, root).select("filepath", "score", "note")


@query("""
select doc_id from documents where doc_id not in (select doc_id from labels)
""")
def partials_resume(spark, d):
    """What the partial tables of an earlier run lack."""
    root = _root(spark)
    partials.append(table(spark, d, "labels").select("doc_id", "toxic"), root)
    return partials.remaining(table(spark, d, "documents").select("doc_id"), root, "doc_id")


@query("""
select o_orderpriority stage, count(*)::bigint files_in, count(*) filter (where o_custkey % 2 = 0)::bigint files_out, '{"limit": 3, "stage": "' || o_orderpriority || '"}' params from orders group by 1
""")
def appended_audit(spark, d):
    root = _root(spark)
    stage = F.col("o_orderpriority").alias("stage")
    counts = table(spark, d, "orders").groupBy(stage).agg(F.count("*").alias("files_in"), F.count_if(F.col("o_custkey") % 2 == 0).alias("files_out"), F.lit(2.0).alias("hours_in"), F.lit(1.0).alias("hours_out"))
    records.append_audits(counts.withColumns({"params": records.json_params(stage=F.col("stage"), limit=F.lit(3)), "sequence": F.lit(0)}), root)
    return stored.audit_log(spark, root).select("stage", "files_in", "files_out", "params")


@query("""
select doc_id filepath, lang, n_chars::bigint n, text from documents
""")
def json_lines(spark, d):
    root = _root(spark)
    records.write_jsonl(table(spark, d, "documents").select(F.col("doc_id").alias("filepath"), "lang", F.col("n_chars").cast("long").alias("n"), "text"), root)
    return spark.read.schema("filepath long, lang string, n long, text string").json(root)


@query("""
select doc_id filepath, 'rover' kind, text from documents where text is not null and doc_id % 4 <> 0
""")
def appended_sidecars(spark, d):
    """A null text leaves what is there."""
    root = _root(spark)
    t = table(spark, d, "documents").select(F.col("doc_id").alias("filepath"), F.when(F.col("doc_id") % 4 != 0, F.col("text")).alias("text"))
    records.append_sidecars(t, root, "rover")
    return spark.read.parquet(root)


@query("""
select 'k_' || doc_id key, 'txt' ext, strlen(text)::bigint n, sha256(text) digest from documents where text is not null
""")
def tar_round_trip(spark, d):
    """Archives written by the tasks and read again."""
    root = _root(spark)
    x = table(spark, d, "documents").where("text is not null")
    x = x.select(F.concat(F.lit("k."), F.col("doc_id").cast("string")).alias("key"), F.lit("txt").alias("ext"), F.encode("text", "utf-8").alias("content"), F.create_map(F.lit("lang"), F.col("lang")).alias("meta"))
    files.write_tars(x, root, most_samples=100).collect()  # a row an archive
    t = files.read_tars(spark, root).where("ext = 'txt'")
    return t.select("key", "ext", F.octet_length("content").cast("long").alias("n"), F.sha2("content", 256).alias("digest"))


@query("""
select vec_id, 64 / 16000.0::double duration from embeddings where embedding is not null
""")
def wav_durations(spark, d):
    """Arrays as WAV files, and their lengths from the headers alone."""
    root = _root(spark)
    e = table(spark, d, "embeddings").where("embedding is not null").select(F.concat(F.col("vec_id").cast("string"), F.lit(".wav")).alias("name"), F.col("embedding").cast("array<double>").alias("x"))
    wav = scorers.scored(e, scorers.FunctionScorer("content binary", lambda: None, files.as_wav), "name", "x").select("name", "content")
    files.write_binaries(wav, root, "name", "content").write.format("noop").mode("overwrite").save()
    out = audio.probe_durations(audio.listing(spark, root))
    return out.select(paths.stem(F.col("path")).cast("long").alias("vec_id"), "duration")


@query("""
select doc_id, case when doc_id % 10 = 0 then 'ZeroDivisionError: division by zero' end error, case when doc_id % 10 <> 0 then 100 / (doc_id % 10) end::double score from documents
""")
def scored_items(spark, d):
    """A scorer whose batches fail: they are halved until only the items that fail are left, and those give their error."""
    x = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 10).alias("item"))
    return scorers.scored(x, scorers.FunctionScorer("score double", lambda: 100, lambda model, items: [(model / i,) for i in items]), "doc_id", "item")


# --- streams ---------------------------------------------------------------------------------


@query("""
select cast(doc_id as varchar) filepath, n_chars::double total_duration, case when doc_id % 2 = 0 then n_chars else n_chars / 10 end::double crest_factor from documents
""")
def absorbed_stream(spark, d):
    """Partials stream into the manifest; a null never erases, the last row of a clip wins."""
    root, m = _root(spark), _manifest(spark, d)
    versions.commit(m.select("filepath", "total_duration", "crest_factor"), f"{root}/manifest")
    part = m.select("filepath", F.when(F.col("filepath").cast("long") % 2 == 0, F.col("total_duration")).alias("crest_factor"), F.lit(2).alias("sequence"))
    part.withColumns({"crest_factor": F.lit(-1.0), "sequence": F.lit(1)}).where("cast(filepath as long) % 2 = 0").unionByName(part).write.parquet(f"{root}/partials")
    absorb(spark, f"{root}/partials", part.schema, f"{root}/manifest", f"{root}/checkpoint").awaitTermination()
    return stored.load(spark, f"{root}/manifest").select("filepath", "total_duration", "crest_factor")


@query("""
select cast(doc_id as varchar) filepath, n_chars::double total_duration, case when doc_id % 100 = 7 then -1 when doc_id % 2 = 0 then n_chars / 2 else n_chars / 10 end::double crest_factor,
  case when doc_id % 100 = 7 then lang end note from documents
""")
def bucketed_manifest(spark, d):
    """A manifest in hash buckets: a batch with two rows a clip, the same batch again, and one of a hundredth of the clips with a new column; a null never erases."""
    root, m = _root(spark), _manifest(spark, d)
    buckets.merge(m.select("filepath", "total_duration", "crest_factor"), root, buckets=16)
    n = F.col("filepath").cast("long")
    part = m.where(n % 2 == 0).select("filepath", (F.col("total_duration") / 2).alias("crest_factor"), F.lit(None).cast("double").alias("total_duration"), F.lit(2).alias("sequence"))
    part = part.unionByName(part.withColumns({"crest_factor": F.lit(-5.0), "sequence": F.lit(1)}))
    for _ in range(2):
        buckets.merge(part, root, order=("sequence",))
    buckets.merge(m.where(n % 100 == 7).select("filepath", F.lit(-1.0).alias("crest_factor"), F.col("lang").alias("note")), root)
    return buckets.read(spark, root).select("filepath", "total_duration", "crest_factor", "note")


@query("""
select cast(doc_id as varchar) filepath, n_chars::double total_duration, case when doc_id % 2 = 0 then n_chars else n_chars / 10 end::double crest_factor from documents
""")
def bucketed_stream(spark, d):
    """Partials stream into a manifest in hash buckets, a file a batch; a replayed stream finds its batches taken."""
    root, m = _root(spark), _manifest(spark, d)
    buckets.merge(m.select("filepath", "total_duration", "crest_factor"), f"{root}/manifest", buckets=8)
    part = m.where("cast(filepath as long) % 2 = 0").select("filepath", F.col("total_duration").alias("crest_factor"), F.lit(2).alias("sequence"))
    part.withColumns({"crest_factor": F.lit(-1.0), "sequence": F.lit(1)}).unionByName(part).repartition(3, "filepath").write.parquet(f"{root}/partials")
    absorb(spark, f"{root}/partials", part.schema, f"{root}/manifest", f"{root}/checkpoint", files=1, buckets=8).awaitTermination()
    return buckets.read(spark, f"{root}/manifest").select("filepath", "total_duration", "crest_factor")


@query("""
select 't' || (o_orderkey % 1000) audio_id, count(distinct o_orderkey % 1000)::bigint n from orders group by 1
""")
def ingested_once(spark, d):
    """Records of two polls; each id is taken once."""
    root = _root(spark)
    o = table(spark, d, "orders").select(F.concat(F.lit("t"), (F.col("o_orderkey") % 1000).cast("string")).alias("audio_id"))
    for _ in range(2):
        o.write.mode("append").json(f"{root}/in")
        ingest(spark, f"{root}/in", o.schema, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(o.schema).parquet(f"{root}/out").groupBy("audio_id").agg(F.count("*").alias("n"))


def _above_last(kept, queued, chunk):
    """A linear scorer: how far a frame's first number lies above the mean of the queue, and a tenth of its second."""
    every = np.concatenate((kept, queued, chunk))
    mean = queued[:, 0].mean() if len(queued) else 0.0
    return np.stack((0.5 + (every[:, 0] - mean) / 997, every[:, 1] / 10), axis=1)


@query("""
with f as (select user_id, coalesce(value, 0) v, event_id, row_number() over (partition by user_id order by event_id) - 1 frame from events),
  c as (select *, frame // 8 chunk from f), m as (select user_id, chunk + 1 chunk, avg(v) a from c group by 1, 2)
select 'u' || user_id source, chunk::bigint chunk, frame::bigint frame, round(0.5 + (v - coalesce(a, 0)) / 997, 6) above, (event_id % 7) / 10::double other from c left join m using (user_id, chunk)
""")
def stateful_chunks(spark, d):
    """Events as frames of their users, eight a chunk: chunks come in three batches, each with every third of all sources, and are scored in order from the state."""
    root, e = _root(spark), table(spark, d, "events").where("user_id is not null")
    frame = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    e = e.withColumn("frame", frame).select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"), "frame", F.floor(F.col("frame") / 8).alias("chunk"), F.array(F.coalesce("value", F.lit(0.0)), (F.col("event_id") % 7).cast("double")).alias("x"), "ts")
    x = F.transform(F.array_sort(F.collect_list(F.struct("frame", "x"))), lambda v: v["x"])
    chunks = e.groupBy("source", "chunk").agg(x.alias("x"), F.max(F.col("ts").cast("timestamp")).alias("ts"))
    chunks = materialise(chunks)
    files = -(-chunks.count() // partitioning.RANGE_ROWS) or 1  # of a batch
    for third in (2, 1, 0):
        chunks.where(F.col("chunk") % 3 == third).repartition(files).write.mode("append").parquet(f"{root}/chunks")
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/chunks").withWatermark("ts", "100 years")
    scored = sources.scored_chunks(stream, _above_last, 2, cache.Rule(size=24, silence=1, speakers=2), 8)
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, sources.ROCKS)
    try:
        scored.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    out = spark.read.schema(sources.OUTPUT).parquet(f"{root}/out").where("not ended")
    return out.select("source", "chunk", "frame", F.round(F.get("p", F.lit(0)), 6).alias("above"), F.get("p", F.lit(1)).alias("other"))


@query("""
with f as (select label source, vec_id frame, embedding e from embeddings where embedding is not null and label is not null),
  p as (select source, frame, unnest([0, 1, 2, 3]) speaker, unnest([0.5 + e[1]::double, 0.5 + e[2]::double, 0.5 + e[3]::double, 0.5 + e[4]::double]) p from f),
  s as (select *, ln(greatest(p, 0.25)) - ln(greatest(1 - p, 0.25)) + sum(ln(greatest(1 - p, 0.25))) over (partition by source, frame) + ln(2) s0 from p),
  k as (select *, count(*) filter (where s0 > 0) over (partition by source, speaker) >= 3 enough from s),
  a as (select *, row_number() over (partition by source, speaker order by s0 desc, frame) r1 from k where p > 0.5 and (s0 > 0 or not enough)),
  b as (select *, s0 + case when r1 <= 5 then 2 * ln(2) else 0 end s1 from a),
  c as (select *, row_number() over (partition by source, speaker order by s1 desc, frame) r2 from b),
  d as (select *, s1 + case when r2 <= 10 then ln(2) else 0 end s2 from c),
  e as (select *, row_number() over (partition by source order by s2 desc, frame, speaker) r3 from d),
  own as (select source, speaker, frame, s2 score from e where r3 <= 28),
  quiet as (select source, unnest([0, 1, 2, 3]) speaker, null::bigint frame, null::double score from (select distinct source from f)),
  slots as (select * from own union all select * from quiet union all select * from quiet union all select * from quiet),
  n as (select source, speaker, frame, score, row_number() over (partition by source order by speaker, frame nulls last) - 1 slot from slots),
  rest as (select source, null::int speaker, null::bigint frame, null::double score, unnest(range(count(*), 40)) slot from n group by source)
select source, slot::int slot, speaker::int speaker, frame, round(score, 6) score from (select * from n union all select * from rest)
""")
def cache_compression(spark, d):
    """Vectors as frames, labels as sources, four of their numbers as chances of four speakers: what a cache of 40 slots keeps."""
    e = table(spark, d, "embeddings").where("embedding is not null and label is not null")
    p = [F.struct(F.lit(i).alias("speaker"), (0.5 + F.get("embedding", F.lit(i)).cast("double")).alias("p")) for i in range(4)]
    frames = e.select(F.col("label").alias("source"), F.col("vec_id").alias("frame"), F.explode(F.array(*p)).alias("v")).select("source", "frame", "v.*")
    return cache.compressed(frames, "source", cache.Rule(size=40)).withColumn("score", F.round("score", 6))


#: Queries whose files, models, archives or state are opaque to the JVM.
PYTHON = {"stateful_chunks", "tar_round_trip", "wav_durations", "scored_items"}
