"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload import inputs
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events".split():
        connection.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    mine = ordered(df.columns, df.collect())
    assert mine == ordered(columns, cursor.fetchall())
    assert mine, "a query over whole tables should find something"


def test_rows_of_records_are_dealt_to_tasks_of_some_size(spark, tmp_path, monkeypatch):
    """As many tasks as rows ask for, not only one per core; rows that flows are made of stay where they are read."""
    monkeypatch.setattr(inputs, "ROWS_A_TASK", 50)
    for name in ("orders", "lineitem"):
        spark.range(2000).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = inputs.table(spark, str(tmp_path), "orders")
    assert orders.count() == orders.distinct().count() == 2000
    assert max(orders.rdd.glom().map(len).collect()) <= 100
    assert inputs.table(spark, str(tmp_path), "lineitem").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_entry(spark):
    assert entry(spark).count() == 3
