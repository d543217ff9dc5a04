import duckdb
import pytest

import __spark_entry__ as entry
from corpusflow import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def rows(frame):
    def plain(v):
        if v is None or str(v) in ("<NA>", "nan", "NaT"):
            return "~"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        try:
            return f"{float(v) + 0.0:.9g}"
        except (TypeError, ValueError):
            return str(v)

    cols = sorted(frame.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in frame[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, duck, name):
    assert rows(catalog.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(catalog.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0
