"""Call signs longer than a message's field."""

import __spark_entry__ as entry
import duckdb
import pytest
from pyspark.sql import functions as F
from seatracks.operators import decode as D


@pytest.mark.parametrize("name", ["nm4_voyages", "nm4_scaled"])
def test_events_above_a_million(spark, tmp_path, name):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id < 100")
    events.withColumn("event_id", F.col("event_id") + 999_940).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got, want = entry.queries()[name](spark, str(tmp_path)), con.sql(entry.oracle_sql()[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_only_what_begins_so_is_completed(spark):
    rows = spark.createDataFrame([(1, "C100000"), (2, "C100000"), (3, "C3"), (4, "C400000"), (None, "C500000")], "imo_id int, callsign string")
    register = spark.createDataFrame([(1, "C1000000"), (2, "D1000000"), (3, "C3000000"), (5, "C5000000")], "imo_id long, callsign string")
    got = D.completed(rows, register, "imo_id", "callsign", 7)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "C1000000"), (2, "C100000"), (3, "C3"), (4, "C400000"), (None, "C500000")], key=str)
