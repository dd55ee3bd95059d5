"""Every registered query against its DuckDB oracle (and ``entry``), on sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["deck_hash", "total_battles", "wins", "win_rate_pct", "avg_elixir"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    # the optional text operators are tested on their own; SQL can't express most of them
    assert set(E.registry.all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    spark_rows = rows_of(sdf.toArrow().to_pylist())
    tab = con.sql(E.oracle_sql()[name]).to_arrow_table()
    assert sorted(sdf.columns) == sorted(tab.column_names)
    assert spark_rows == rows_of(tab.to_pylist())
