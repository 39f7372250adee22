"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(float(value)) if isinstance(value, float) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=str)


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, small, name):
    df = driver.queries()[name](spark, small)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    relation = duck.sql(driver.oracle_sql()[name])
    assert got == table(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", ["forecast_best", "hour_clusters", "rf_small", "zone_levels"])
def test_other_queries_return_rows(spark, small, name):
    assert driver.queries()[name](spark, small).count() > 0


def test_every_model_of_the_summary_succeeds(spark, small):
    rows = driver.queries()["model_summary"](spark, small).collect()
    assert {r["status"] for r in rows} == {"SUCCESS"} and len({r["model"] for r in rows}) == 5


def test_entry(spark):
    assert "risk_score" in driver.entry(spark).columns
