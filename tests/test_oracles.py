"""Every query that has SQL gives the same rows as DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = pd.to_datetime(df[c], utc=True).dt.tz_localize(None).astype("datetime64[us]")
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:  # one type for both where only the width differs
        if got[c].dtype != want[c].dtype and got[c].dtype.kind in "iuf" and want[c].dtype.kind in "iuf":
            got[c], want[c] = got[c].astype(float), want[c].astype(float)
    assert len(got) == len(want) and len(got) > 0 and plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
