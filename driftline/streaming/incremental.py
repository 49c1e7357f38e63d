"""Structured Streaming forms of the engine's batch accumulation: flows added up, first routes kept, trips counted by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.operators import flows


def _version(path: str, epoch: int) -> str:
    return f"{path}/epoch={epoch}"


#: Versions of a state that are kept.
KEPT = 3


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs whose version is complete, ascending."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch=*/_SUCCESS")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest complete state under a path, or None."""
    epochs = _epochs(spark, path)
    return spark.read.parquet(_version(path, epochs[-1])) if epochs else None


def _versioned(stream: DataFrame, path: str, checkpoint: str, start, merge) -> StreamingQuery:
    """A state that each micro-batch merges into the newest complete version before its own epoch. Every epoch writes a version
    of its own, so one that runs again gives the same state; a version that is missing or half written is an error, since
    epochs follow each other without gaps. Only the last KEPT versions stay."""

    def step(batch: DataFrame, epoch: int) -> None:
        spark, new = batch.sparkSession, start(batch)
        if epoch:
            if epoch - 1 not in _epochs(spark, path):
                raise ValueError(f"{_version(path, epoch - 1)} is not complete")
            new = merge(spark.read.parquet(_version(path, epoch - 1)), new)
        new.write.mode("overwrite").parquet(_version(path, epoch))
        for old in _epochs(spark, path):
            if old <= epoch - KEPT:
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_version(path, old))
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(step).start()


def upsert_flows(stream: DataFrame, path: str, checkpoint: str, key: str = "id", value: str = "total_trips") -> StreamingQuery:
    """Adds each micro-batch (key, value) to the state under path."""
    return _versioned(stream, path, checkpoint, lambda b: b.groupBy(key).agg(F.sum(value).alias(value)), lambda old, new: flows.add_to(old, new, key, value))


def first_routes_table(stream: DataFrame, path: str, checkpoint: str, key: str = "od_id") -> StreamingQuery:
    """The first row of each key that arrives, kept as a table under path, so that no state of the stream grows for ever.
    Of rows that arrive together the smallest counts."""

    def start(batch: DataFrame) -> DataFrame:
        rest = [c for c in batch.columns if c != key]
        return batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*").select(*batch.columns)

    return _versioned(stream, path, checkpoint, start, lambda old, new: flows.first_wins(old, new, key))


def first_routes(stream: DataFrame, key: str = "od_id", ts: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key that arrives; with ts, a key is forgotten once events are ``late`` past it. Without, the state grows
    with the number of keys: use ``first_routes_table`` for streams that do not end."""
    if ts:
        return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def daily_volume(stream: DataFrame, ts: str = "starting_time", late: str = "1 day") -> DataFrame:
    """day, trips; a day is closed once events are ``late`` past its end."""
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return rows.groupBy(F.window(ts, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("trips")).select(F.to_date("w.start").alias("day"), "trips")
