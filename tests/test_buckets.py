"""The manifest in hash buckets: what is rewritten, what readers see, and what a crash leaves."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.manifest import upsert
from corpusflow.sinks import buckets

SCHEMA = "filepath string, a long, b string"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/m"


def test_a_small_batch_leaves_other_buckets_alone(spark, root):
    main = spark.range(1_000_000).select(F.concat(F.lit("k"), F.col("id")).alias("filepath"), F.col("id").alias("a"), F.lit("x").alias("b"))
    buckets.merge(main, root, buckets=256)
    before = buckets.snapshot(spark, root)
    batch = spark.range(100).select(F.concat(F.lit("k"), F.col("id") * 9973).alias("filepath"), F.lit(-1).cast("long").alias("a"))
    assert buckets.merge(batch, root) == 1
    after = buckets.snapshot(spark, root)
    touched = {r[0] for r in batch.select(buckets.bucket_of(F.col("filepath"), 256)).collect()}
    assert 0 < len(touched) < 100
    assert {b for b in range(256) if before.files[b] != after.files[b]} == touched
    got = buckets.read(spark, root)
    want = upsert(main, batch)
    assert got.exceptAll(want).count() == 0 and got.count() == 1_000_000
    assert buckets.merge(batch, root) is None  # the same again
    assert buckets.snapshot(spark, root).version == 1


@pytest.mark.parametrize("preserve", [True, False])
def test_any_batches_equal_upserts(spark, root, preserve):
    rng = random.Random(5)
    want = None
    for k in range(25):  # past a full record
        own = [(f"k{rng.randrange(60)}", rng.choice([None, rng.randrange(4)]), rng.choice([None, "", "t"]), i) for i in range(rng.randrange(1, 12))]
        last = {r[0]: r[:3] for r in own}
        batch = spark.createDataFrame([*own, (None, 1, "no key", 99)], SCHEMA + ", sequence int")
        buckets.merge(batch, root, order=("sequence",), preserve=preserve, buckets=7)
        new = spark.createDataFrame(list(last.values()), SCHEMA)
        want = new if want is None else spark.createDataFrame(upsert(want, new, preserve=preserve).collect(), SCHEMA)
    assert rows(buckets.read(spark, root)) == rows(want)
    middle = buckets.versions(spark, root)[3]
    assert buckets.read(spark, root, middle).count() <= want.count()
    assert buckets.read(spark, root, 1_000) is None


def test_columns_come_later(spark, root):
    buckets.merge(spark.createDataFrame([("a", 1, None), ("b", 2, "x")], SCHEMA), root, buckets=4)
    buckets.merge(spark.createDataFrame([("b", 2.5), ("c", None)], "filepath string, score double"), root)
    assert rows(buckets.read(spark, root)) == rows(spark.createDataFrame([("a", 1, None, None), ("b", 2, "x", 2.5), ("c", None, None, None)], SCHEMA + ", score double"))
    with pytest.raises(ValueError):
        buckets.merge(spark.createDataFrame([("b", "text")], "filepath string, a string"), root)
    with pytest.raises(ValueError):
        buckets.merge(spark.createDataFrame([(1, 1)], "id long, a long"), root, key="id")


def test_a_crash_before_the_record_changes_nothing(spark, root, monkeypatch):
    buckets.merge(spark.createDataFrame([(f"k{i}", i, "x") for i in range(20)], SCHEMA), root, buckets=4)
    before = rows(buckets.read(spark, root))
    batch = spark.createDataFrame([("k1", 100, "y")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            buckets.merge(batch, root)
    assert rows(buckets.read(spark, root)) == before
    assert buckets.vacuum(spark, root) == 1
    assert buckets.merge(batch, root, source="s", batch_id=4) == 1
    assert buckets.merge(spark.createDataFrame([("k1", 7, "z")], SCHEMA), root, source="s", batch_id=4) is None  # taken
    assert buckets.merge(spark.createDataFrame([("k1", 7, "z")], SCHEMA), root, source="other", batch_id=0) == 2


def test_a_version_is_committed_once(spark, root):
    batch = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    buckets.merge(batch, root, buckets=2)
    at = buckets.snapshot(spark, root)
    with pytest.raises(RuntimeError):
        buckets._commit(spark, root, 0, "filepath", 2, at.schema, {}, {}, True)
    assert rows(buckets.read(spark, root)) == rows(batch)


def test_resize_and_vacuum(spark, root):
    main = spark.createDataFrame([(f"k{i}", i, "x") for i in range(50)], SCHEMA)
    buckets.merge(main, root, buckets=3)
    for i in range(3):
        buckets.merge(spark.createDataFrame([(f"k{i}", 1000, "x")], SCHEMA), root)
    want = rows(buckets.read(spark, root))
    buckets.resize(spark, root, 11)
    assert buckets.snapshot(spark, root).buckets == 11 and rows(buckets.read(spark, root)) == want
    assert buckets.vacuum(spark, root, keep=1) > 0
    assert rows(buckets.read(spark, root)) == want
    buckets.merge(spark.createDataFrame([("k1", 5, "y")], SCHEMA), root)
    assert buckets.read(spark, root).where("a = 5 and b = 'y'").count() == 1


def test_empty(spark, root):
    none = spark.createDataFrame([], SCHEMA)
    assert buckets.read(spark, root) is None
    buckets.merge(none, root, buckets=2)
    assert buckets.read(spark, root).count() == 0
    assert buckets.merge(none, root) is None
