"""Sums over everything before a row, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.llm.shared import written

#: Rows that one window adds up.
BLOCK = 1024


def sums_before(rows: DataFrame, index: str, value: str, block: int = BLOCK) -> DataFrame:
    """(index, before): for each row, the sum of `value` over the rows of a smaller `index`.

    `index` is a whole number from 0 up, different in each row; gaps are allowed. Blocks of `block`
    index values are added up first, then blocks of blocks, so a window never holds more than `block`
    rows, however many there are. A null value counts 0. An empty table gives an empty table.
    """
    rows = written(rows.select(F.col(index).cast("long").alias("i"), F.coalesce(value, F.lit(0)).alias("v")), "totals")
    largest = rows.agg(F.max("i")).first()[0]
    rows = rows.withColumn("block", F.floor(F.col("i") / block))
    inside = Window.partitionBy("block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("v").over(inside), F.lit(0)))
    if largest is not None and largest >= block:
        blocks = rows.groupBy("block").agg(F.sum("v").alias("v"))
        outside = sums_before(blocks, "block", "v", block).withColumnsRenamed({"block": "b", "before": "outside"})
        rows = rows.join(outside, rows.block == outside.b).withColumn("inside", F.col("inside") + F.col("outside"))
    return rows.select(F.col("i").alias(index), F.col("inside").alias("before"))
