"""Source catalogues: ids in pages and nested objects, tracks, link lists."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TRACK

# Patterns of ids in pages.
PAGE_PATTERNS = (r"/album/(\d+)", r"\\u002Falbum\\u002F(\d+)", r"\\/album\\/(\d+)")


def page_ids(pages: DataFrame, key: str, html: str, patterns: Sequence[str] = PAGE_PATTERNS, limit: int | None = None) -> DataFrame:
    """(key, id, pos): ids in the order of the patterns and then of the page, each once; at most `limit` a page."""
    found = F.concat(*[F.regexp_extract_all(html, F.lit(p), 1) for p in patterns])
    each = pages.select(key, F.posexplode(found).alias("pos", "id"))
    first = each.groupBy(key, "id").agg(F.min("pos").cast("long").alias("pos"))
    if limit is None:
        return first
    return first.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("__r") <= limit).drop("__r")


def object_ids(objects: DataFrame, column: str, key: str) -> DataFrame:
    """(key, pos, id) of all objects in JSON texts, at any depth, in reading order.

    The depth is unbounded, so the walk is Python over Arrow batches.
    """

    def walk(x) -> Iterator[str]:
        if isinstance(x, dict):
            own = x.get("id") or x.get("album_id")
            if own is not None:
                yield str(own)
            for v in x.values():
                yield from walk(v)
        elif isinstance(x, list):
            for v in x:
                yield from walk(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    found = dict.fromkeys(walk(json.loads(raw))) if raw else {}
                except ValueError:
                    found = {}
                rows += [(k, i, x) for i, x in enumerate(found)]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())], [key, "pos", "id"])

    return objects.select(key, column).mapInArrow(run, f"{key} {dict(objects.dtypes)[key]}, pos int, id string")


def tracks(spark: SparkSession, path: str) -> DataFrame:
    """Track records of JSON lines or of a JSON array."""
    return spark.read.schema(TRACK).option("multiLine", path.endswith(".json")).json(path)


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of JSON lines; blank lines are none. A line that doesn't parse is an error that names its file and number."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("__file"), F.posexplode(F.split("value", "\r?\n")).alias("__n", "__line")).where("trim(__line) <> ''")
    wide = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    parsed = lines.withColumn("__x", F.from_json("__line", wide, {"columnNameOfCorruptRecord": "__bad"}))
    message = F.concat(F.col("__file"), F.lit(": line "), (F.col("__n") + 1).cast("string"), F.lit(" is no JSON record"))
    sound = F.when(F.col("__x.__bad").isNotNull() | F.col("__x").isNull(), F.raise_error(message)).otherwise(F.col("__x"))
    return parsed.select(sound.alias("__x")).select(*[F.col(f"__x.{f.name}").alias(f.name) for f in schema.fields])


def audio_id(track: Column, album: Column) -> Column:
    """track:album, or the track alone."""
    return F.concat_ws(":", track, F.nullif(album, F.lit("")))


def flatten_tracks(df: DataFrame) -> DataFrame:
    """A row a track of nested records: id, title with its version, artists as text, album parts, link."""
    return df.select(
        audio_id(F.col("track_id"), F.col("album.id")).alias("audio_id"), "track_id", F.col("album.id").alias("album_id"), "title", F.array_join("artists", ", ").alias("artists"),
        "duration_ms", F.col("album.title").alias("album_title"), F.coalesce("track_url", F.concat(F.col("album.url"), F.lit("/track/"), F.col("track_id"))).alias("track_url"),
    )


def source_urls(df: DataFrame, base: str) -> DataFrame:
    """Distinct links in order: an object's own, or the base and its id."""
    url = F.coalesce(F.nullif(F.col("url"), F.lit("")), F.concat(F.lit(base), F.col("id")))
    return df.select(url.alias("url")).where("url is not null").distinct().orderBy("url")


def expand(sources: DataFrame, key: str, items: str, limit: int | None = None) -> DataFrame:
    """(key, pos, item): each source's items, at most `limit`; a source without any gives no row."""
    own = sources.select(key, F.posexplode(items).alias("pos", "item"))
    return own if limit is None else own.where(F.col("pos") < limit)


def is_podcast(*texts: str) -> Column:
    # Words of a podcast's name.
    return F.lower(F.concat_ws(" ", *texts)).rlike("podcast|подкаст")


def best_link(df: DataFrame, key: str, link: str, bitrate: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(link, bitrate).alias("link"))
