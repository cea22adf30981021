"""Values carried along an order that no single task holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of the order that a block spans.
BLOCK = 1 << 16


def last_known(df: DataFrame, group: Sequence[str], order: str, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Adds the last value that isn't null up to each row, in a group's order (a whole number, once in a group).

    The order is cut into blocks. A window runs inside each; what a block begins with comes from one row for each block
    before it. So no task holds more of a group than a block, or a row for each of its blocks. The group's columns aren't
    null.
    """
    keys = [*group, "_block"]
    rows = df.withColumn("_block", F.floor(F.col(order) / block)).withColumn("_value", value)
    ends = rows.groupBy(*keys).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_end"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, F.last("_end", ignorenulls=True).over(before).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(ends, keys).withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_start"))).drop("_block", "_value", "_start")
