"""Every registered query against its SQL on DuckDB, over the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import pytest

from loomdocs.plans import adapters, catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in adapters.GIVEN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(x) for x in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(catalog.oracle_sql()[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == columns
    places = [named.index(c) for c in columns]
    assert got == Counter(tuple(plain(row[i]) for i in places) for row in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0


def test_ingest_equals_sql_with_repeated_urls(spark, tmp_path):
    """A URL is one record, however many pages it has; null and empty ones are none."""
    import duckdb

    urls = ["http://a/1", "http://a/1", "http://a/2", None, "", "http://a/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, catalog.queries()["ST1_stream_ingest"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(catalog.oracle_sql()["ST1_stream_ingest"]).fetchall()) == [("http://a/1", "indexed"), ("http://a/2", "indexed")]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
