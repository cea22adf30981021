"""Tables in the folder that all machines share, by which long plans are cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared folder; a temporary one only on one machine that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/seatracks-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes a table and rereads it: what is made from it begins there, also after an executor is lost."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
