"""Incremental upserts: partial results stream into the manifest in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.manifest import keep_last, upsert
from ..sinks import buckets as bucketed
from ..sinks.versions import commit, current


def absorb_batch(batch: DataFrame, root: str, key: str = "filepath", order: tuple[str, ...] = ("sequence",), preserve: bool = True) -> None:
    """One batch into a new manifest version; the last row of a key wins, and a batch that comes again changes nothing."""
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    new = keep_last(batch, key, *order).drop(*[o for o in order if o != key])
    path = current(spark, root)
    commit(upsert(spark.read.parquet(path), new, key, preserve) if path else new, root)


def absorb(spark: SparkSession, partials: str, schema: T.StructType, root: str, checkpoint: str, seconds: int | None = None, key: str = "filepath", files: int | None = None, preserve: bool = True,
           buckets: int | None = None, rows: str | None = None) -> StreamingQuery:
    """Stream Parquet partials into the manifest at root: every `seconds`, or all there is and then stop.

    The checkpoint remembers which files are done, so partials need no deleting; `files` bounds a batch. With `buckets` the manifest is one of sinks.buckets, of
    which a batch rewrites the changed buckets only; a batch that comes again after a crash is known by its number. rows: a folder that gets a batch's number of rows.
    """

    def take(batch: DataFrame, number: int) -> None:
        if buckets:
            bucketed.merge(batch, root, key, ("sequence",), preserve, buckets, checkpoint, number)
        else:
            absorb_batch(batch, root, key, preserve=preserve)
        if rows:  # the same folder if it comes again
            batch.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{rows}/batch={number}")

    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    out = reader.parquet(partials).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=f"{seconds} seconds") if seconds else out.trigger(availableNow=True)).start()


def absorb_when(spark: SparkSession, partials: str, schema: T.StructType, root: str, checkpoint: str, rows: int, key: str = "filepath", buckets: int | None = None) -> bool:
    """Absorb the partials once `rows` rows or more are waiting; whether it did. Rows count once a batch has taken them, and once only if the batch comes again. All are
    counted from the footers of their files."""
    taken = f"{checkpoint}/rows"
    done = spark.read.parquet(taken).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if _exists(spark, taken) else 0
    have = spark.read.schema(schema).parquet(partials).count() if _exists(spark, partials) else 0
    if have - done < rows:
        return False
    absorb(spark, partials, schema, root, f"{checkpoint}/stream", key=key, buckets=buckets, rows=taken).awaitTermination()
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
