"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import check
from demo.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, tables, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = tables.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.same_rows(check.normal(got), check.normal(want)) == "ok"


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 15


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == {"train_entry", "train_exit"}
