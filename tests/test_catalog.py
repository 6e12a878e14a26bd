"""Every query of the sales engine against its SQL on the smallest data set."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from run_checks import TABLES, rows_of
from salescope_checks.catalog import CATALOG

SF_DIR = entry_module.FLAGSHIP_DIR


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(CATALOG) <= set(entry_module.queries())
    assert set(CATALOG) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("key", list(CATALOG))
def test_query_matches_sql(spark, sql, key):
    df = entry_module.queries()[key](spark, SF_DIR)
    cursor = sql.execute(entry_module.oracle_sql()[key])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
