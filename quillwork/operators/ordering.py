"""Rows numbered in an order, on all partitions at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import settle


def positioned(df: DataFrame, *order: Column | str, out: str = "position", first: int = 1) -> DataFrame:
    """``df`` with its gapless place in an order that may use any expression of its columns.

    Rows are range-partitioned and sorted once, numbered in each partition, and moved on by the rows of
    the partitions before: that window runs over one row per partition.  Rows that tie in the order
    are numbered in any order; give enough columns to decide it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("_place", F.monotonically_increasing_id())
                    .withColumn("_split", F.shiftright("_place", 33)))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = placed.groupBy("_split").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    offsets, size = settle_measured(splits.select(
        "_split", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + first)
        .alias("_start")))
    numbered = join_measured(placed, offsets, size, ["_split"])
    return numbered.select(*df.columns, (F.col("_place") + F.col("_start")).alias(out))
