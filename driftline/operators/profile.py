"""Feasibility figures: daily volume and how many pairs cover how many trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.to_date("starting_time").alias("day")).agg(F.count(F.lit(1)).alias("trips"))


def extremes(days: DataFrame) -> DataFrame:
    """Mean, largest and smallest day, in one row; ties go to the earlier day."""
    return days.agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("trips").alias("mean"),
        F.max("trips").alias("most"),
        F.min("trips").alias("least"),
        F.min_by("day", F.struct(-F.col("trips"), "day")).alias("most_on"),
        F.min_by("day", F.struct("trips", "day")).alias("least_on"),
    )


def coverage(pairs: DataFrame, shares: tuple[int, ...] = (50, 80, 90, 95)) -> DataFrame:
    """percent, pairs: how many of the most frequent pairs carry more than that share of all trips.

    The running total runs over distinct trip counts, not pairs: each count c with m pairs adds a block of m * c, and
    within the block the number of pairs follows by division, so the window holds as many rows as there are counts.
    """
    blocks = pairs.groupBy("trip_count").agg(F.count(F.lit(1)).alias("m"))
    up = Window.orderBy(F.desc("trip_count"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    rows = blocks.select(
        "trip_count",
        "m",
        F.coalesce(F.sum(F.col("m") * F.col("trip_count")).over(before), F.lit(0)).alias("done"),
        F.sum(F.col("m") * F.col("trip_count")).over(every).alias("total"),
    )
    percent = rows.withColumn("percent", F.explode(F.array(*(F.lit(p) for p in shares))))
    # pairs k of the block with 100 (done + k c) <= percent * total
    room = F.floor((F.col("percent") * F.col("total") - 100 * F.col("done")) / (100 * F.col("trip_count")))
    inside = F.greatest(F.lit(0), F.least(F.col("m"), room))
    return percent.groupBy("percent").agg((F.sum(inside) + 1).cast("long").alias("pairs"))
