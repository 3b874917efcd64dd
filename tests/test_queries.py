"""Every query with SQL against DuckDB on a small scale, and the driver's entry points."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from ridgeline.plans import gaps, network, queries, tours  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    def cell(v):
        if pd.isna(v):
            return "null"
        return str(v) if isinstance(v, str | bool) or type(v).__name__ == "bool" else repr(float(v) + 0.0)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(cell(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_is_its_sql(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(queries.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
