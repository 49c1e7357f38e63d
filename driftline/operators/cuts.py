"""Lineage cuts in the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a temporary folder if driver and executors are one process (tests); on a
    cluster, where they would not see each other's files, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    return (base or _LOCAL.get(app) or _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="driftline-"))).rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read again, so that iterations neither recompute it nor carry its plan along."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """rows with ``name``: 1, 2, ... in the given order, which is total.

    Rows are dealt into ranges, written once so that the cuts cannot move, and numbered within them; of each range only a
    count meets the others in one task.
    """
    dealt = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # one row a range
    out = dealt.withColumn("_r", place).join(F.broadcast(counts), "_part").withColumn(name, (F.col("_r") + F.col("_n")).cast("long"))
    return out.drop("_part", "_r", "_n")
