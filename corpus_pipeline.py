"""The corpus pipeline: documents in, packed sequences out, one operator a stage.

An empty table gives an empty one. Every stage but the last returns the columns of its documents, works on all that the stage before kept, and is written as
Parquet in the shared folder before the next one reads it, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, lines, packing, quality, simhash
from corpusflow.llm.common import discard_since, materialise, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go: toxic and poor ones, and null and empty texts. Repeated rows are judged alike."""
    return quality.select(docs, table(spark, sf_dir, "labels"), train_on=table(spark, sf_dir, "documents"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that spread over many sites are cut out; all documents stay, null texts and repeated rows too, with their length where they have that column."""
    out = lines.deduplicate(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with similar five-word shingles, the document with the smallest id stays; null and empty texts are one
    group, rows without an id and rows that share the smallest id stay."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go, row by row; null and empty texts stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences; a null or empty text is its end token alone, a row without an id is packed."""
    return packing.packed(docs, packing.public_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold every stage and run() against sets of planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), written()
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
        discard_since(spark, mark, docs)  # the stage before and what this one wrote on its way
    return docs
