"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from rolecall.plans import oracle, registry

TABLES = os.environ.get("ROLECALL_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES, ORACLE = registry.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}"))
    return repr(value)


def test_queries_and_sql_pair_up():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    rows = sorted(tuple(normal(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    answer = duck.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(normal(r[i]) for i in order) for r in answer.fetchall())


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables are not here")
    assert entry.entry(spark).count() > 0
