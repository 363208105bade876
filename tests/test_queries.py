import os

import duckdb
import pytest

import __spark_entry__ as E
from tidewell.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        path = f"{DATA}/{file}"
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([str(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order]) for r in values)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert 0 < len(E.entry(spark).collect()) <= 10


def test_every_query_of_the_library_has_sql():
    assert registry.queries().keys() == registry.oracle_sql().keys()
    assert registry.queries().keys() <= E.queries().keys()


def test_scan_reads_only_what_is_asked_for(spark):
    plan = registry.queries()["filter_range"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,10" in plan and "l_extendedprice" not in plan.split("ReadSchema")[1]


def test_joins_and_loads_of_whole_tables(spark):
    found, size = registry.queries(), lambda t: spark.read.parquet(f"{DATA}/{t}.parquet").count()
    assert found["join_right"](spark, DATA).count() == size("orders")
    assert found["write_trim_documents"](spark, DATA).count() == found["copy_truncate_documents"](spark, DATA).count() == size("documents")
