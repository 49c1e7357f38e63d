"""The engine's inputs, derived from the driver's tables: trips from events, points and a street graph from embeddings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions import geo
from driftline.operators import clean, spatial, trips
from driftline.operators.cuts import folder, numbered
from driftline.sources.readers import exists


#: Where inputs that take work to build have been written: by application, source folder and name.
_BUILT: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The table that build makes, written to the shared folder by the first query of an application that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT or not exists(spark, f"{_BUILT[key]}/_SUCCESS"):
        path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
        build(spark, sf_dir).write.parquet(path)
        _BUILT[key] = path
    return spark.read.parquet(_BUILT[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip from each event to the user's next one; the last has no end."""
    k = F.get_json_object("props", "$.k").cast("int")
    by_user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ride_id"), F.col("event_type").alias("bike_type"), k.alias("start_sid"), F.lead(k).over(by_user).alias("end_sid"),
        F.col("ts").alias("starting_time"), F.lead("ts").over(by_user).alias("ending_time"),
    )


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips(spark, sf_dir).where(clean.valid_duration(F.col("starting_time"), F.col("ending_time")))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label, x, y (whole numbers), geom of all vectors."""
    at = lambda k: F.round(F.get("embedding", k).cast("double") * 100000).cast("long")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", at(0).alias("x"), at(1).alias("y"))
    return rows.withColumn("geom", geo.point(F.col("x"), F.col("y")))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).where("id < 100").select(F.col("id").alias("sid"), F.col("label").alias("borough"), "x", "y", "geom")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).where("id >= 100").select("id", "x", "y", "geom")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, source, target, cost, reverse_cost (closed), geom: from each vertex to its four nearest."""
    return _once(spark, sf_dir, "edges", _edges)


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = spatial.nearest_others(vertices(spark, sf_dir), "id", "geom", 4, places=True)
    near = near.select(F.col("id").alias("s"), F.col("target").alias("t"), F.round(F.sqrt("d2")).cast("long").alias("w"), geo.point(F.col("px"), F.col("py")).alias("a"), geo.point(F.col("tx"), F.col("ty")).alias("b"))
    near = numbered(near, "id", "s", "t")
    return near.select("id", F.col("s").alias("source"), F.col("t").alias("target"), F.col("w").alias("cost"), F.lit(-1).cast("long").alias("reverse_cost"), F.array("a", "b").alias("geom"))


def snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, vertex: the nearest vertex of each station."""
    return _once(spark, sf_dir, "snapped", _snapped)


def _snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = spatial.nearest_point(stations(spark, sf_dir), "sid", "geom", vertices(spark, sf_dir), "id", "geom")
    return near.select("sid", F.col("target").alias("vertex"))


def od(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "od", lambda spark, sf_dir: trips.numbered(trips.od_pairs(valid_trips(spark, sf_dir))))


def combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.combinations(od(spark, sf_dir), snapped(spark, sf_dir))


def lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points as degrees near 74 W, 40.7 N."""
    p = points(spark, sf_dir)
    return p.select("id", geo.point(F.col("x") / 1e6 - 74.0, F.col("y") / 1e6 + 40.7).alias("geom"))


def boxes(spark: SparkSession) -> DataFrame:
    """name, geom: four areas that leave gaps between them, with half numbers as bounds so that no point lies on one."""
    rows = [("east", 500.5, -60000.5, 60000.5, -2000.5), ("north", 500.5, 500.5, 60000.5, 60000.5), ("south", -60000.5, -60000.5, -500.5, -500.5), ("west", -60000.5, 1000.5, -500.5, 60000.5)]
    data = [(n, [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]) for n, x0, y0, x1, y1 in rows]
    return spark.createDataFrame(data, f"name string, geom array<{geo.LINE}>")
