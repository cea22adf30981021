"""Readers and writers that no single task holds: numbered lines, carried values, database ranges, base tables."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seatracks.operators import decode as D
from seatracks.operators import normalize as N
from seatracks.operators.carry import last_known
from seatracks.plans import messages as M
from seatracks.sources import readers as R
from seatracks.sources import writers as W

from .test_operators import pings, signed

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


@pytest.mark.parametrize("block", [3, 1000])
def test_last_known(spark, block):
    rng = random.Random(block)
    data = [(g, i, rng.choice([None, None, rng.randrange(9)])) for g in ("a", "", "b") for i in rng.sample(range(-50, 200), 90)]
    got = last_known(spark.createDataFrame(data, "g string, i long, v int"), ["g"], "i", F.col("v"), "known", block)
    want, known = [], {}
    for g, i, v in sorted(data):
        known[g] = v if v is not None else known.get(g)
        want.append((g, i, v, known[g]))
    assert sorted((r.g, r.i, r.v, r.known) for r in got.collect()) == want
    assert all("_block" in w for w in plan_of(got).split("Window [last")[2:])


def test_a_log_in_blocks_gives_the_rows_of_a_whole_one(spark):
    rng, log, parts = random.Random(6), [], []
    for i in range(400):
        log.append(("f", i, rng.choice([f"0{rng.randrange(1, 9)},07,15,12,00,00,ADT data:", "!a", "!b", ""])))
        body = f"AIVDM,2,{rng.choice([1, 1, 2])},1,{rng.choice('AB')},{'x' * rng.randrange(1, 4)},0"
        parts.append(("f", i, f"d{i}", signed(body)))
    lines = spark.createDataFrame(log, "path string, line_no long, line string")
    assert sorted(R.receiver_dates(lines, block=7).collect()) == sorted(R.receiver_dates(lines).collect())
    ok, _ = D.verify_sentences(spark.createDataFrame(parts, "path string, line_no long, date string, sentence string"))
    whole = sorted(D.assemble(ok).collect())
    assert sorted(D.assemble(ok, block=5).collect()) == whole and whole


def test_files_are_scanned_once(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\r\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = R.read_lines(spark, str(tmp_path))
        assert sorted((r.path[-5], r.line_no, r.line) for r in lines.collect()) == [(n, i + 1, f"{n}{i}") for n in "ab" for i in range(2000)] or sorted((r.line[0], r.line_no) for r in lines.collect()) == [(n, i + 1) for n in "ab" for i in range(2000)]
        assert "FileScan text" not in plan_of(lines) and "Scan text" not in plan_of(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("by", ["time", "mmsi"])
def test_database_ranges(spark, by):
    url, driver = "jdbc:derby:memory:seatracks;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rng = random.Random(1)
    p = pings(spark, [(316000000 + 90_000 * (k % 23), rng.randrange(9) * 86400 + k, 44, -63) for k in range(500)]).unionByName(pings(spark, [(1, 0, 44, -63)]).withColumn(by, F.lit(None)))
    p.write.mode("overwrite").jdbc(url, f"pings_{by}", properties={"driver": driver})
    got = R.read_pings_jdbc(spark, url, f"pings_{by}", by, partitions=5, driver=driver)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, p.collect()))
    sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 5 and max(r["count"] for r in sizes) < 200
    plan = plan_of(got.where("latitude > 10").select("mmsi"))
    assert "PushedFilters: [" in plan and "GreaterThan(latitude" in plan.replace("*", "") and "heading" not in plan.split("PushedFilters")[0].split("Scan")[-1]


def test_even_ranges():
    assert R.even_ranges([(i, 1) for i in range(10)], 5) == [2, 4, 6, 8]
    assert R.even_ranges([(1, 100), (2, 1), (3, 1)], 3) == [2, 3] and R.even_ranges([], 4) == []


def test_base_tables_skip_files_and_row_groups(spark, tmp_path):
    rng = random.Random(3)
    data = [(t, T0 + dt.timedelta(hours=rng.randrange(2000)), rng.uniform(-70, -40), rng.uniform(40, 60)) for t in (1, 5, 18) for _ in range(1500)]
    rows = spark.createDataFrame(data, "t int, time timestamp, longitude double, latitude double")
    ee = rows.select(F.lit("x_2015-01-02.csv").alias("path"), F.monotonically_increasing_id().alias("line_no"), *[{"mmsi": F.lit("5"), "message_id": F.col("t").cast("string"), "time": F.date_format("time", "yyyyMMdd_HHmmss"), "longitude": F.col("longitude").cast("string"), "latitude": F.col("latitude").cast("string")}.get(c, F.lit(None).cast("string")).alias(c) for c in R.EE_COLUMNS])
    home = str(tmp_path / "base")
    W.write_base_rows(N.ee_rows(ee), home)
    got = W.read_base_rows(spark, home, "1_2_3", "2020-02", "2020-02", (-55, -50, 45, 50))
    want = [r for r in data if r[0] == 1 and r[1].month == 2 and -55 <= r[2] <= -50 and 45 <= r[3] <= 50]
    assert sorted(r.longitude for r in got.collect()) == sorted(r[2] for r in want) and want
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(msg_group" in plan and "month" in plan.split("PartitionFilters")[1] and "GreaterThanOrEqual(longitude,-55.0)" in plan
    files = list((tmp_path / "base" / "msg_group=1_2_3" / "month=2020-02").glob("*.parquet"))
    stats = [pq.ParquetFile(f).metadata.row_group(0).column(pq.ParquetFile(f).schema_arrow.get_field_index("longitude")).statistics for f in files]
    met = [s for s in stats if s.max >= -55 and s.min <= -50]
    assert sum(s.max - s.min for s in stats) < 40  # files divide the range of longitudes rather than each holding all of it
    assert len(files) == 1 or len(met) < len(files)


T0 = dt.datetime(2020, 1, 1)


def test_split_in_one_pass(spark, tmp_path):
    M._ee(spark, SF).write.parquet(str(tmp_path / "ee"))
    rows = N.ee_rows(spark.read.parquet(str(tmp_path / "ee")))
    assert plan_of(rows.groupBy("msg_group").count()).count("Scan parquet") == 1
    tables = N.split_ee(spark.read.parquet(str(tmp_path / "ee")))
    assert sum(t.count() for t in tables.values()) == rows.count()
