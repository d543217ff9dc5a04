"""Manifests and partial tables from CSV or Parquet, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths
from ..operators.manifest import keep_last
from ..schema import AUDIT, MANIFEST, conformed
from ..sinks.versions import current, versions


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV manifest: every column as text, then conformed; nothing is inferred, so ids keep their zeros. An empty file is an empty table."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    if not raw.columns:
        return spark.createDataFrame([], MANIFEST)
    named = raw if "filepath" in raw.columns else raw.withColumn("filepath", F.lit(""))
    return conformed(named if columns is None else named.select(*columns))


def load(spark: SparkSession, root: str) -> DataFrame:
    """The last committed version; an empty manifest if there is none."""
    path = current(spark, root)
    return conformed(spark.read.parquet(path)) if path else spark.createDataFrame([], MANIFEST)


def load_or_previous(spark: SparkSession, root: str) -> DataFrame:
    """The newest version that can be read."""
    for path in versions(spark, root)[::-1]:
        try:
            return conformed(spark.read.parquet(path))
        except Exception:  # noqa: BLE001, S112
            continue
    return spark.createDataFrame([], MANIFEST)


def bootstrap(spark: SparkSession, root: str, found: DataFrame) -> DataFrame:
    """The manifest, or one row for each file found (filepath)."""
    own = load_or_previous(spark, root)
    return own if not own.isEmpty() else conformed(found.select("filepath").distinct())


def audio_paths(manifest: DataFrame) -> DataFrame:
    return manifest.select("filepath").where(F.col("filepath").isNotNull() & paths.is_audio(F.col("filepath"))).dropDuplicates()


def partials(spark: SparkSession, pattern: str, key: str = "filepath") -> DataFrame:
    """All partial tables of a pattern; of a key's rows the last counts: by file name, then by place in the file."""
    raw = spark.read.option("header", True).csv(pattern)
    placed = raw.withColumns({"__file": F.col("_metadata.file_name"), "__block": F.col("_metadata.file_block_start"), "__row": F.monotonically_increasing_id()})
    return keep_last(placed, key, "__file", "__block", "__row").drop("__file", "__block", "__row")


def pending_rows(spark: SparkSession, pattern: str) -> int:
    """Rows in partial tables."""
    return spark.read.option("header", True).csv(pattern).count()


def duration_cache(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(filepath, total_duration) above 0 of the wanted clips: two columns are read."""
    own = manifest.select("filepath", "total_duration").where("total_duration > 0")
    return own.join(wanted.select("filepath").distinct(), "filepath", "left_semi")


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*AUDIT.fields, T.StructField("sequence", T.LongType())])).parquet(path)


def metadata_by_stem(manifest: DataFrame) -> DataFrame:
    """A row a clip for exports, keyed by its whole path and by stem; of equal paths the last by `sequence`, if there is one."""
    own = keep_last(manifest, "filepath", "sequence") if "sequence" in manifest.columns else manifest.dropDuplicates(["filepath"])
    return own.withColumn("stem", paths.stem(F.col("filepath")))


def recover(collated: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clips to cut again joined to their sources (path, playlist_id, podcast_id), and those without a source."""
    s = sources.select(F.col("path").alias("source_path"), "playlist_id", "podcast_id")
    keys = ["playlist_id", "podcast_id"]
    return collated.join(s, keys), collated.join(s, keys, "left_anti")
