"""Stations: one row an id, tagged with the area it lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import geo
from driftline.operators.clean import first_per_key, in_area
from driftline.operators.spatial import tag_within


def roles(trips: DataFrame, columns: tuple[str, ...] = ("station_id", "station_name", "lat", "lng")) -> DataFrame:
    """One row for the start and one for the end of each trip, from one scan."""
    ends = F.array(*(F.struct(*(F.col(f"{w}_{c}").alias(c) for c in columns)) for w in ("start", "end")))
    return trips.select(F.explode(ends).alias("e")).select("e.*")


def mode(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The most frequent combination of values of each key, with its count; ties go to the smallest values."""
    counted = rows.groupBy(key, *values).agg(F.count(F.lit(1)).alias("count"))
    return first_per_key(counted, [key], [F.col("count").desc(), *(F.col(v).asc() for v in values)])


def stations(trips: DataFrame, s: Settings = Settings()) -> DataFrame:
    """station_id, station_name, geom, geom_utm, count and sid (1, 2, ... by station_id) of each station in the area."""
    rows = in_area(roles(trips).na.drop(), "lat", "lng", s)
    top = mode(rows, "station_id", ["station_name", "lat", "lng"])
    geom = geo.point(F.col("lng"), F.col("lat"))
    from pyspark.sql import Window

    # a row a station: small enough for one task
    sid = F.row_number().over(Window.orderBy("station_id"))
    return top.select(sid.alias("sid"), "station_id", "station_name", geom.alias("geom"), geo.to_utm(geom).alias("geom_utm"), "count")


def tagged(st: DataFrame, areas: DataFrame, geom: str = "geom") -> DataFrame:
    """Stations inside an area, with its name as ``borough``; the others are dropped. areas: name, geom (polygon)."""
    return tag_within(st, areas, "sid", geom).withColumnRenamed("area", "borough")


def invalid(st: DataFrame) -> DataFrame:
    return st.where(~geo.is_point(F.col("geom")))


def departures(st: DataFrame, trips: DataFrame) -> DataFrame:
    """Every station with the number of trips that start there, zero included."""
    counts = trips.groupBy(F.col("start_sid").alias("sid")).agg(F.count(F.lit(1)).alias("departures"))
    return st.join(counts, "sid", "left").withColumn("departures", F.coalesce("departures", F.lit(0).cast("long")))


def per_area(st: DataFrame) -> DataFrame:
    return st.groupBy("borough").agg(F.count(F.lit(1)).alias("stations"))
