"""Plans are what the operators promise: no Python where an expression does it, pruned scans, no products."""

import re

import pytest

from corpusflow import catalog

DATA = "/root/testdata/sf0.001"
PYTHON = catalog.PYTHON


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_products(spark, name):
    p = plan(catalog.QUERIES[name](spark, DATA))
    if name not in PYTHON:
        assert not re.search("Python|Pandas|Arrow", p)
    assert "CartesianProduct" not in p
    # nested loops only against a row that an aggregate made
    assert p.count("BroadcastNestedLoopJoin") <= 1


@pytest.mark.parametrize(("name", "columns"), [("score_distribution", {"event_type", "value"}), ("totals", {"l_orderkey", "l_quantity"}), ("dedupe_keep_last", {"doc_id", "text", "lang"}), ("crest_factor", {"vec_id", "embedding"})])
def test_scans_are_pruned(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<(.*?)>+(?:\n|$| )", plan(catalog.QUERIES[name](spark, DATA)) + "\n")
    got = {c.split(":")[0] for r in read for c in re.sub(r"<[^>]*>?", "", r).split(",")}
    assert got == columns


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[.*IsNotNull\(value\)", plan(catalog.QUERIES["threshold_preview"](spark, DATA)))


def test_agreement_of_columns_shuffles_nothing(spark, tmp_path):
    from corpusflow.plans import queries

    rows = [(0, "One two"), (1, "one two"), (2, None), (3, " \t"), (4, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.asr_agreement(spark, str(tmp_path))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    # a clip without any words has no row, as in the SQL
    assert {r[0]: r[1] for r in out.collect()} == {r[0]: r[1] for r in queries.asr_agreement_long(spark, str(tmp_path)).collect()} == {0: 100.0, 1: 50.0, 4: 100.0}
