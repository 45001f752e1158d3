"""The registered language, reader and writer queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from tidewire.plans import language_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in df.values.tolist())


@pytest.mark.parametrize("name", sorted(language_queries.SQL))
def test_query_equals_its_sql(spark, con, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    want = con.execute(__spark_entry__.oracle_sql()[name]).df()
    assert len(got) and sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
