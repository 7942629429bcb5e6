"""A rank over a whole table without a single task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import written


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with its 1-based place in the given total order.

    The rows are sorted by ranges; each range numbers its own rows and is offset by the
    sizes of the ranges before it. The sorted rows are written once, so that both uses
    see the same ranges. Only one row per range goes through the last window.
    """
    mask = (1 << 33) - 1
    rows = written(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    out = rows.withColumn("_part", part).join(offsets, "_part")
    return out.withColumn(name, F.col("_before") + F.col("_place").bitwiseAND(F.lit(mask)) + 1).drop("_part", "_place", "_before")


def summed_before(df: DataFrame, rank: str, value: str, name: str, size: int = 10_000) -> DataFrame:
    """df with the sum of `value` over all rows of lower rank, in two levels of `size` ranks each."""
    rows = df.withColumn("_block", F.floor((F.col(rank) - 1) / size))
    blocks = rows.groupBy("_block").agg(F.sum(value).alias("_sum"))
    over = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(blocks, "_block").withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0)))
    return out.drop("_block", "_before")
