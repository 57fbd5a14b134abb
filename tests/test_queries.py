from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from test_scale import plan_of
from workload import queries as workload_queries

SF = "/root/testdata/sf0.001"
# Tables of the test data.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Those of the mix library; the training-data operators have tests of their own.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in workload_queries.QUERIES}
SQL = {name: text for name, text in entry_points.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ordered = df.select(*columns)
    found = Counter(tuple(r) for r in ordered.collect())
    plan = plan_of(ordered)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "REPARTITION_BY_NUM" not in plan
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert found == expected and found


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["user", "tracks", "mixId", "atDate"]
