"""Every registered query against its SQL, run by DuckDB on the same files."""

import pathlib

import pytest

import __spark_entry__ as driver
from envstream.checks.oracle import oracle
from envstream.checks.queries import registered

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = registered(), oracle()
WITHOUT_SQL = {"rf_predictions", "rf_metrics"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as from '{path}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_only_the_forest_has_no_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    expected = tables.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(expected.columns, expected.fetchall())
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: kinds[t] for c, t in df.dtypes} == types


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_forest_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_all_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_results_do_not_depend_on_the_time_zone(spark, sf_dir, tables):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        for name in ("unified", "fact_air", "fetch_plan", "encode_roundtrip", "split_counts"):
            test_query_equals_sql(spark, sf_dir, tables, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
