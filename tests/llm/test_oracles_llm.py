"""Operators whose results SQL can say, against DuckDB over a whole table."""

import os

import duckdb
import pytest

from seatracks.llm import llm_queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = llm_queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(llm_queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    have = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert have == sorted(want.select(", ".join(columns)).fetchall()) and have
