"""Work in shards: fixed sizes, length buckets, splits and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import bucket_index, bucket_label
from ..functions.text import is_missing
from ..sinks.scratch import materialise

SHARD_SIZE = 10_000


#: Rows of a range, about.
RANGE_ROWS = 250_000


def numbered(df: DataFrame, by: list[str], order: list[str], ranges: int | None = None, weight: str | None = None) -> DataFrame:
    """df with __row: the row's number from 0 in its group, in the given order; with a weight, the sum of the weights before it.

    There are as many ranges as the rows ask for. No task sees a whole group: rows are dealt into ranges of (group, order), ranked inside their range, and each range's start is the sum of
    the counts before it. Ranges come from a sample, so they are written once; a second evaluation could draw others.
    """
    n = F.lit(1) if weight is None else F.col(weight)
    ranges = ranges or max(8, -(-df.count() // RANGE_ROWS))
    ranged = df.repartitionByRange(ranges, *by, *order).withColumn("__part", F.spark_partition_id())
    ranged = materialise(ranged)
    counts = ranged.groupBy("__part", *by).agg(F.sum(n).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row a range and group: written, so that Spark knows its size and sends it to all tasks only if it is small
    offsets = counts.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__by_{c}") for c in by], before.alias("__before"))
    same = (F.col("__part") == F.col("__p")) & reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by], F.lit(True))
    inside = Window.partitionBy("__part", *by).orderBy(*order)
    rank = F.row_number().over(inside) - 1 if weight is None else F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - n
    placed = ranged.withColumn("__rank", rank).join(materialise(offsets), same)
    return placed.withColumn("__row", F.col("__rank") + F.col("__before")).drop("__part", "__p", "__before", "__rank", *[f"__by_{c}" for c in by])


#: Rows up to which percentiles of all groups, and of one, are taken by Spark's aggregate.
PERCENTILE_ROWS, GROUP_ROWS = 5_000_000, 100_000
#: Of quantile sketches: ranks are off by a share of 1 / ACCURACY at most, and brackets reach SLACK times as far.
ACCURACY, SLACK = 10_000, 3


def percentiles(df: DataFrame, by: list[str], value: str, points: list[float], most: int = PERCENTILE_ROWS, group_rows: int = GROUP_ROWS, accuracy: int = ACCURACY) -> DataFrame:
    """(by..., q array<double>): exact percentiles of a number that is not null, interpolated linearly between the two rows around each.

    Up to `most` rows in all, and of groups of at most `group_rows` (and `accuracy`) rows, Spark's own aggregate does it, which holds a group's distinct values in one
    task. Of larger groups mergeable quantile sketches give a bracket around each rank; a second scan keeps the values inside the brackets, those of
    a few rows in ten thousand, and of the rows between two brackets only their number, so ranks are exact. All ways give the same.
    """
    own = df.select(*by, F.col(value).cast("double").alias("__v")).where("__v is not null")
    exact = F.percentile("__v", F.array(*[F.lit(float(p)) for p in points])).alias("q")
    if own.count() <= most:
        return own.groupBy(*by).agg(exact)
    edges = [min(max(p + side * SLACK / accuracy, 0.0), 1.0) for p in points for side in (-1, 1)]
    sketch = F.when(F.count("*") > max(group_rows, accuracy), F.percentile_approx("__v", edges, accuracy)).alias("__edges")
    # written, so that Spark knows the size of a row a group and sends it to all tasks only if it is small
    groups = materialise(own.groupBy(*by).agg(F.count("*").alias("__total"), sketch))
    large = beside(own, groups.where("__edges is not null").select(*by, "__edges"), by)
    edge = lambda i, side: F.get("__edges", F.lit(2 * i + side))
    lo = [F.lit(float("-inf")) if edges[2 * i] == 0 else edge(i, 0) for i in range(len(points))]
    hi = [F.lit(float("nan")) if edges[2 * i + 1] == 1 else edge(i, 1) for i in range(len(points))]  # NaN is above all numbers
    v = F.col("__v")
    outside = ~reduce(lambda x, y: x | y, [(v >= a) & (v <= b) for a, b in zip(lo, hi)])
    # a row outside all brackets counts behind the last bracket below it
    at = F.when(outside, F.greatest(F.lit(float("-inf")), *[F.when(b < v, b) for b in hi])).otherwise(v)
    placed = large.select(*by, outside.alias("__outside"), at.alias("__v")).groupBy(*by, "__v", "__outside").agg(F.count("*").alias("__n"))
    # written: the numbering reads it more than once
    counted = numbered(materialise(placed), by, ["__v", "__outside"], weight="__n")
    counted = beside(counted, groups.select(*by, "__total"), by)
    each = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("__total") - 1)).alias("at")) for i, p in enumerate(points)])
    holds = lambda k: (k >= F.col("__row")) & (k < F.col("__row") + F.col("__n"))
    asked = F.filter(each, lambda x: holds(F.floor(x["at"])) | holds(F.ceil(x["at"])))
    held = counted.select(*by, "__v", "__outside", "__row", "__n", F.explode(asked).alias("__x")).select("*", F.col("__x.i").alias("__i"), F.col("__x.at").alias("__at"))
    value_ = F.when(F.col("__outside"), F.raise_error(F.lit("a percentile lies outside its bracket"))).otherwise(v)
    one = held.groupBy(*by, "__i").agg(
        F.max(F.when(holds(F.floor("__at")), value_)).alias("a"), F.max(F.when(holds(F.ceil("__at")), value_)).alias("b"), F.first(F.col("__at") - F.floor("__at")).alias("f"),
    )
    pairs = one.select(*by, "__i", (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("v"))
    found = pairs.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "v"))), lambda x: x["v"]).alias("q"))
    found = found.where("size(q) > 0")  # without groups an aggregate of no rows is a row, too
    some = groups.where("__edges is null and __total > 0")
    if some.isEmpty():
        return found
    small = beside(own, some.select(*by), by) if by else own
    return small.groupBy(*by).agg(exact).where("q is not null").unionByName(found)


def beside(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """a and b, a row a group of b, side by side; groups may be null."""
    if not by:
        return a.crossJoin(F.broadcast(b))  # b has one row
    b = b.withColumnsRenamed({c: f"__of_{c}" for c in by})
    return a.join(b, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in by])).drop(*[f"__of_{c}" for c in by])


def fixed_shards(df: DataFrame, path: str, *order: str, size: int = SHARD_SIZE, limit: int | None = None) -> DataFrame:
    """df with shard numbers of `size` rows in the given order; blank paths go."""
    own = df.where(~is_missing(F.col(path)))
    if limit is not None:
        own = own.orderBy(*order).limit(limit)
    return numbered(own, [], list(order)).withColumn("shard", F.floor(F.col("__row") / size)).drop("__row")


def length_shards(df: DataFrame, duration: str, *order: str, width: float = 1.0, most: float = 15.0, size: int = SHARD_SIZE) -> DataFrame:
    """df with bucket, label and shard: by length bucket, inside it by length, in slices of `size`. A bucket may hold most rows."""
    b = numbered(df.withColumn("bucket", bucket_index(F.col(duration), width, most)), ["bucket"], [duration, *order])
    return b.withColumn("shard", F.floor(F.col("__row") / size)).drop("__row").withColumn("label", bucket_label(F.col("bucket"), width, most))


def by_length(df: DataFrame, duration: str, partitions: int) -> DataFrame:
    """Ranges of similar length, sorted inside: batches pad little. For scoring jobs, which need no shard numbers."""
    return df.repartitionByRange(partitions, duration).sortWithinPartitions(duration)


def round_robin(df: DataFrame, workers: int) -> DataFrame:
    return df.repartition(workers)


def strided(df: DataFrame, path: str, workers: int) -> DataFrame:
    """df with worker: row k in the order of the path goes to worker k mod `workers`."""
    return numbered(df, [], [path]).withColumn("worker", F.pmod("__row", F.lit(workers))).drop("__row")


def contiguous(df: DataFrame, path: str, workers: int) -> DataFrame:
    """df with worker: runs in the order of the path, as even as can be, the longer ones first."""
    own = numbered(df, [], [path])
    n = own.agg(F.count("*").alias("__n"))
    size, more = F.floor(F.col("__n") / workers), F.pmod("__n", F.lit(workers))
    worker = F.when(F.col("__row") < more * (size + 1), F.floor(F.col("__row") / (size + 1))).otherwise(more + F.floor((F.col("__row") - more * (size + 1)) / F.greatest(size, F.lit(1))))
    return own.crossJoin(F.broadcast(n)).withColumn("worker", worker).drop("__row", "__n")


def padded(df: DataFrame, key: str, samples: str, size: int) -> DataFrame:
    """df with batch, and samples padded with zeros to the longest of their batch: batches of `size` rows in the order of the key; null samples go."""
    own = numbered(df.where(F.col(samples).isNotNull()), [], [key]).withColumn("batch", F.floor(F.col("__row") / size)).drop("__row")
    longest = F.max(F.size(samples)).over(Window.partitionBy("batch"))
    return own.withColumn(samples, F.concat(F.col(samples).cast("array<double>"), F.array_repeat(F.lit(0.0), longest - F.size(samples))))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by the hash of key and seed: the same for any partitioning."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def limit_per_group(df: DataFrame, group: str, n: int, *order: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)
