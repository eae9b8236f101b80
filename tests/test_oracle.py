"""Every registered query against the same result in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as driver
from shelfline.plans.feeds import SOURCE_TABLES
from shelfline.plans.oracle import ORACLES as TEXTS, oracle_text
from shelfline.plans.queries import QUERIES

DIR = "/root/testdata/sf0.001"
ORACLES = {name: oracle_text(name) for name in TEXTS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def canonical(table, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in table.to_pylist())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, DIR).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    assert canonical(got, columns) == canonical(want, columns)


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
