"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from workload.compare import connect, differences
from workload.registry import QUERIES as CLEANING

QUERIES, ORACLES = {name: run for name, run in entry.queries().items() if name in CLEANING}, entry.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


@pytest.mark.filterwarnings("ignore::silverline.operators.columns.MissingColumnWarning")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, ORACLES[name], database) == []


def test_differences_are_found(spark, database):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    sql = "SELECT * FROM (VALUES (1::BIGINT, 'a'), (2::BIGINT, 'c')) t(id, v)"
    assert len(differences(df, sql, database)) == 2
    assert differences(df.selectExpr("CAST(id AS INT) AS id", "v"), sql, database)[0].startswith("schema")


def test_every_query_has_sql():
    assert set(CLEANING) <= set(ORACLES)


def test_entry(spark):
    rows = {r.column: r for r in entry.entry(spark).collect()}
    assert set(rows) == {"name", "city", "email", "phone", "country", "created_at", "updated_at", "registration_date"}
    assert rows["name"].unknown > 0 and rows["created_at"].failed_dates > 0 and rows["country"].review > 0
