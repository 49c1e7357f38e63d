"""Lineage cuts and order statistics that survive the loss of an executor.

Everything is written as Parquet under ``spark.checkpoint.dir``, a folder that the driver and all executors share.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_MADE: list[str] = []
#: Keys with more rows than HOT are met without a shuffle, at most MOST_HOT of them (the hottest), so the rest have few rows each.
HOT, MOST_HOT = 1_000, 10_000


def root(spark: SparkSession) -> str:
    """The session's folder under spark.checkpoint.dir. Where that is unset, a temporary one if driver and executors are
    one process (tests); on a cluster, where they would not see each other's files, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _LOCAL.get(app) or _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="driftline-"))
    return f"{base.rstrip('/')}/driftline-{app}"


def place(spark: SparkSession, name: str) -> str:
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def mark() -> int:
    """A point in time for ``sweep``."""
    return len(_MADE)


def sweep(spark: SparkSession, since: int, keep: str) -> None:
    """Delete all folders made after the mark, but keep: what they held has been written there."""
    for path in [p for p in _MADE[since:] if p != keep]:
        remove(spark, path)
        _MADE.remove(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df once and continue from the files: later stages never recompute it."""
    return settle_at(df, place(df.sparkSession, name))


def settle_at(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def meet(rows: DataFrame, counted: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) by key with counted, which has one row a key and the number of its rows. Both are read
    twice: settle them.

    The hottest keys, a bounded number, are broadcast, so that no task gets all rows of one key; the others are shuffled.
    """
    hot = counted.where(F.col(count) > HOT).orderBy(F.desc(count), key).limit(MOST_HOT)
    if not hot.take(1):
        return rows.join(counted, key, how)
    hot = settle(hot, "hot")
    names = F.broadcast(hot.select(key))
    cold = rows.join(names, key, "left_anti").join(counted.join(names, key, "left_anti"), key, how)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def hottest(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys with most rows, at most MOST_HOT of those with more than HOT, settled; None if there is none."""
    hot = settle(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > HOT).orderBy(F.desc("_c"), key).limit(MOST_HOT).select(key), "hot")
    return hot if hot.take(1) else None


def beside(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """rows joined by key with a table of one bounded row a key; the table's rows of the hottest keys are broadcast."""
    if hot is None:
        return rows.join(table, key)
    names = F.broadcast(hot)
    return rows.join(F.broadcast(table.join(names, key)), key).unionByName(rows.join(names, key, "left_anti").join(table, key))


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete all that this session has settled. Call it once no result that reads from there is needed."""
    remove(spark, root(spark))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list, within: list[str] | None = None, total=None, name: str = "ranked") -> DataFrame:
    """df, settled in ascending order, with ``rank`` (1, 2, ... over all rows, or within the columns of ``within``)
    and, if ``total`` (a Column) is given, ``before``: its sum over all earlier rows of the same group.

    The rows are dealt into ranges once and written with the number of their range, so that a retried task cannot move
    the cuts. Only one row per range and group (counts and sums) meets in a window over all ranges.
    """
    spark, within = df.sparkSession, within or []
    keys = [*(F.col(c).asc_nulls_last() for c in within), *order]
    dealt = df.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    dealt = settle(dealt.withColumn("_part", F.spark_partition_id()), name)
    amount = F.coalesce(total, F.lit(0)) if total is not None else F.lit(0)
    local = Window.partitionBy("_part", *within).orderBy(*order)
    out = dealt.withColumn("rank", F.row_number().over(local).cast("long"))
    out = out.withColumn("before", F.sum(amount).over(local.rowsBetween(Window.unboundedPreceding, -1)))
    sums = dealt.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", *within, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s"))
    # one row per range and group: bounded by the number of partitions plus the number of groups
    on = out["_part"] == sums["_part"]
    for c in within:
        on = on & out[c].eqNullSafe(sums[c])
    joined = out.join(sums, on, "inner")
    return joined.select(
        *(out[c] for c in df.columns), (out["rank"] + sums["_n"]).alias("rank"), (F.coalesce(out["before"], F.lit(0)) + sums["_s"]).alias("before")
    )
