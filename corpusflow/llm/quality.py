"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is a unit vector of hashed features (words, their beginnings, punctuation
runs, words in capitals, words said twice running; the square roots of their shares).
One weight vector is shared by all grades and ordered thresholds cut its score: P(grade > k) = sigmoid(w.x - t_k).
That gives the expected grade and the chance of the top grade, by which documents are selected.

Grades: 0 toxic, 1 poor, 2 good. The model is fitted in one task on a bounded sample of labelled documents
(TRAIN_ROWS, the smallest hashes of doc_id); scoring reads every whole text where it lies, without a shuffle.

Defined results: null and empty texts have no features and are rejected (expected grade 0, chance 0); without any labels
every other text gets the top grade; labels that are null, and rows without a doc_id, don't train; of rows that share a doc_id one trains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, SPACED, Block, blocks, drop_caches, give_back, lean, runs, span_hashes, table

#: Labelled documents that the model is fitted on, at most.
TRAIN_ROWS = 8192
BITS = 18
GRADES = 3
#: Documents of the sample that must have a feature for it to count.
SEEN = 4
#: Passes over the sample: at least EPOCHS, and as many as make STEPS steps.
EPOCHS, STEPS, BATCH, RATE = 30, 2000, 64, 0.5
#: Inverse variance of the weights' prior: shared by the rows of the sample, so it counts less the more there are.
PRIOR = 0.25
#: A document stays if its chance of the top grade is at least this.
KEEP = 0.6
SEED = 5

#: Bytes of a word's beginning that make a feature.
PREFIX = 5
_LOUD, _AGAIN = np.uint64(0xC0FFEE << 8), np.uint64(0xFACADE << 8)
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of a block, sorted by document."""
    low = LOWER[block.buf]
    s, e = runs(ALNUM[low])
    word = span_hashes(block.buf, s, e) | np.uint64(1)
    ps, pe = runs(~ALNUM[low] & SPACED[low])
    mark = span_hashes(block.buf, ps, np.minimum(pe, ps + 4), lower=False) & ~np.uint64(1)
    capitals = np.concatenate(([0], np.cumsum(_CAPITAL[block.buf])))
    loud = (capitals[e] - capitals[s] == e - s) & (e - s > 1)
    owner = np.searchsorted(block.starts, s, side="right")
    again = np.concatenate(([False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])))[: len(word)]
    long = e - s > PREFIX  # inflected and compound words share their beginning
    prefix = span_hashes(block.buf, s[long], s[long] + PREFIX) ^ np.uint64(0x5DEECE66D << 16)
    at = np.concatenate((s, ps, s[long], s[loud], s[again]))
    hashed = np.concatenate((word, mark, prefix, np.full(int(loud.sum()), _LOUD), np.full(int(again.sum()), _AGAIN)))
    doc = np.searchsorted(block.starts, at, side="right") - 1
    index = (hashed >> np.uint64(7)).astype(np.int64) & ((1 << BITS) - 1)
    key, n = np.unique((doc << BITS) | index, return_counts=True)
    doc, index = key >> BITS, key & ((1 << BITS) - 1)
    total = np.bincount(doc, n, len(block.ids))
    return doc, index, np.sqrt(n / total[doc])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, weights: np.ndarray | None = None, thresholds: np.ndarray | None = None):
        self.weights = np.zeros(1 << BITS) if weights is None else weights
        self.thresholds = np.arange(GRADES - 1) - (GRADES - 2) / 2 if thresholds is None else thresholds

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        return _sigmoid(score[:, None] - self.thresholds)

    def score(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document, and whether it has any features."""
        doc, index, value = features(block)
        n = len(block.ids)
        return np.bincount(doc, self.weights[index] * value, n), np.bincount(doc, minlength=n) > 0

    def fit(self, grades: np.ndarray, indexes: list[np.ndarray], values: list[np.ndarray]) -> Model:
        """AdaGrad on the likelihood of each grade; thresholds stay ordered."""
        rng = np.random.Generator(np.random.PCG64(SEED))
        seen = np.bincount(np.concatenate(indexes), minlength=1 << BITS) >= SEEN  # rarer features only tell rows apart
        indexes, values = [i[seen[i]] for i in indexes], [v[seen[i]] for i, v in zip(indexes, values)]
        grade_of = np.bincount(grades, minlength=GRADES) + 1
        share = np.cumsum(grade_of[::-1])[::-1][1:] / grade_of.sum()
        self.thresholds = -np.log(share / (1 - share))
        t_sum, w_sum = np.ones(GRADES - 1), np.full(1 << BITS, 1e-3)
        for _ in range(max(EPOCHS, -(-STEPS // max(1, -(-len(grades) // BATCH))))):
            order = rng.permutation(len(grades))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                rows = np.repeat(np.arange(len(own)), [len(indexes[i]) for i in own])
                index, value = np.concatenate([indexes[i] for i in own]), np.concatenate([values[i] for i in own])
                score = np.bincount(rows, self.weights[index] * value, len(own))
                p = np.hstack((np.ones((len(own), 1)), self.above(score), np.zeros((len(own), 1))))
                g = grades[own]
                r = np.arange(len(own))
                hi, lo = p[r, g], p[r, g + 1]  # P(grade >= g), P(grade > g)
                chance = np.maximum(hi - lo, 1e-9)
                d_hi, d_lo = hi * (1 - hi) / chance, lo * (1 - lo) / chance
                step = (d_hi - d_lo)[rows] * value / len(own)
                used, back = np.unique(index, return_inverse=True)
                grad = np.bincount(back, step) - PRIOR / len(grades) * self.weights[used]
                w_sum[used] += grad**2
                self.weights[used] += RATE * grad / np.sqrt(w_sum[used])
                t_grad = np.zeros(GRADES + 1)
                np.add.at(t_grad, g, -d_hi)
                np.add.at(t_grad, g + 1, d_lo)
                t_grad = t_grad[1:-1] / len(own)
                t_sum += t_grad**2
                self.thresholds = np.maximum.accumulate(self.thresholds + RATE * t_grad / np.sqrt(t_sum))
        return self


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(grade, indexes, values) of at most `limit` labelled documents; of rows that share a doc_id one, whatever their order."""
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") <= 0, 1).otherwise(2)
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id").alias("rated_id"), grade.alias("grade"))
    rated = rated.groupBy("rated_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("rated_id"), "rated_id").limit(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in blocks([batch]):
                doc, index, value = features(block)
                cut = np.searchsorted(doc, np.arange(len(block.ids) + 1))
                rows = [(index[a:b].astype(np.int32).tobytes(), value[a:b].astype(np.float32).tobytes()) for a, b in zip(cut, cut[1:])]
                ids, grades = (batch.column(k).slice(at, len(rows)) for k in (0, 2))
                at += len(rows)
                yield pa.RecordBatch.from_arrays([ids, grades, pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["doc_id", "grade", "indexes", "values"])

    # the sample has a fixed bound, so it may be broadcast: texts are not shuffled
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = own.join(F.broadcast(rated), own["doc_id"] == rated["rated_id"]).select("doc_id", "text", F.col("grade").cast("int").alias("grade"))
    rows = joined.mapInArrow(lean(run), "doc_id long, grade int, indexes binary, values binary")
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("grade", "indexes", "values"), F.xxhash64("indexes", "values")).alias("x"))
    return one.orderBy("doc_id").select("x.grade", "x.indexes", "x.values")


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Model | None:
    """The model fitted in one task; None without labelled documents."""

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        indexes = [np.frombuffer(x, np.int32).astype(np.int64) for x in part["indexes"]]
        values = [np.frombuffer(x, np.float32).astype(np.float64) for x in part["values"]]
        model = Model().fit(part["grade"].to_numpy(np.int64), indexes, values)
        return pd.DataFrame({"weights": [model.weights.astype(np.float32).tobytes()], "thresholds": [model.thresholds.tobytes()]})

    got = training_rows(docs, labels, limit).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "weights binary, thresholds binary").collect()
    if not got:
        return None
    return Model(np.frombuffer(got[0]["weights"], np.float32).astype(np.float64), np.frombuffer(got[0]["thresholds"], np.float64))


def scored(spark: SparkSession, model: Model | None):
    """A column function: text -> struct<expected_grade, top_chance>."""
    sent = spark.sparkContext.broadcast(model)

    def score(text: pa.Array) -> pa.Array:
        drop_caches()
        own = sent.value
        grade, top = [], []
        for block in blocks([pa.RecordBatch.from_arrays([pa.nulls(len(text)), text], ["doc_id", "text"])]):
            if own is None:
                some = np.bincount(np.searchsorted(block.starts, runs(SPACED[block.buf])[0], side="right") - 1, minlength=len(block.ids)) > 0
                above = np.ones((len(block.ids), GRADES - 1))
            else:
                value, some = own.score(block)
                above = own.above(value)
            grade.append(np.where(some, above.sum(axis=1), 0.0))
            top.append(np.where(some, above[:, -1], 0.0))
        give_back()
        join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0))
        return pa.StructArray.from_arrays([join(grade), join(top)], ["expected_grade", "top_chance"])

    # arrow_udf reads the kind of function from types, and annotations in this module are strings
    score.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, "expected_grade double, top_chance double")


def select(docs: DataFrame, labels: DataFrame, train_on: DataFrame | None = None, keep: float = KEEP, limit: int = TRAIN_ROWS) -> DataFrame:
    """docs whose chance of the top grade is at least `keep`; all columns. The model is fitted on train_on, else on docs."""
    score = scored(docs.sparkSession, train(docs if train_on is None else train_on, labels, limit))
    return docs.where(score(F.col("text"))["top_chance"] >= keep)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = scored(spark, train(docs, table(spark, sf_dir, "labels")))
    out = docs.select("doc_id", score(F.col("text")).alias("s"))
    return out.select("doc_id", "s.expected_grade", "s.top_chance", (F.col("s.top_chance") >= KEEP).alias("kept"))
