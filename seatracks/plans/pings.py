"""Position reports derived from the ``events`` table, by one SQL text for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PINGS = """
SELECT 316000000 + user_id AS mmsi,
       date_trunc('hour', ts) AS time,
       CASE WHEN event_type = 'signup' THEN 18 ELSE 1 END AS message_id,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id % 8 AS INT) END AS navigational_status,
       CAST((event_id * 7) % 250 AS DOUBLE) / 1e1 AS sog,
       CAST((event_id * 13) % 3600 AS DOUBLE) / 1e1 AS cog,
       CAST(CASE WHEN event_id % 11 = 0 THEN 511 ELSE (event_id * 17) % 360 END AS DOUBLE) AS heading,
       CASE WHEN event_id % 97 = 0 THEN 91e0
            WHEN event_type = 'error' THEN 44e0 + CAST(user_id % 10 AS DOUBLE) / 1e2
            ELSE 44e0 + CAST((event_id * 31) % 400 AS DOUBLE) / 1e3 END AS latitude,
       CASE WHEN event_id % 97 = 0 THEN 181e0
            WHEN event_type = 'error' THEN -63e0
            WHEN event_id % 41 = 0 THEN -43e0
            ELSE -63e0 + CAST((event_id * 53) % 600 AS DOUBLE) / 1e3 END AS longitude,
       event_id
FROM events
"""


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PINGS.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
