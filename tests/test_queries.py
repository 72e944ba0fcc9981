"""Every engine query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from stackrill.plans import queries as engine

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = engine.queries()[name](spark, SF).toPandas()
    want = duck.sql(engine.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = lambda df: sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(engine.queries()) - set(engine.oracle_sql())))
def test_runs(spark, name):
    assert engine.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
