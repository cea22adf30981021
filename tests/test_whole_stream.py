"""The stream counts messages of several sentences, whatever the blocks of its files."""

from pyspark.sql import functions as F

from seatracks.plans import messages as M
from seatracks.streaming import nm4 as ST

SF = "/root/testdata/sf0.001"


def test_stream_counts_equal_the_batch(spark):
    got = {r.key: r.n for r in M.q_stream_histogram(spark, SF).collect()}
    assert got == {r.key: r.n for r in M.q_nm4_type_histogram(spark, SF).collect()} and got["5"] > 0


def test_lines_keep_their_order_over_blocks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.txt").write_text("".join(f"d{i} {name}{i}\r\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
    try:
        out = ST.run_available(ST.stream_nm4(spark, str(tmp_path / "in")).withColumn("task", F.spark_partition_id()), str(tmp_path / "out"))
        rows = out.orderBy("path", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.date, r.sentence) for r in rows] == [(f"d{i}", f"{name}{i}") for name in "ab" for i in range(3000)]
    assert len({(r.path, r.line_no) for r in rows}) == 6000 and len({r.task for r in rows}) > 2
