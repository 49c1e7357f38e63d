"""Trips between stations, and directed origin-destination pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators import cuts


def between_stations(trips: DataFrame, st: DataFrame) -> DataFrame:
    """Trips whose both ends are known stations, by id and name, with their sids. The station table is small
    against the trips; Spark broadcasts it if its size allows."""
    a = st.select(F.col("station_id").alias("start_station_id"), F.col("station_name").alias("start_station_name"), F.col("sid").alias("start_sid"), F.col("geom").alias("start_geom"))
    b = st.select(F.col("station_id").alias("end_station_id"), F.col("station_name").alias("end_station_name"), F.col("sid").alias("end_sid"), F.col("geom").alias("end_geom"))
    joined = trips.join(a, ["start_station_id", "start_station_name"]).join(b, ["end_station_id", "end_station_name"])
    return joined.select("ride_id", "bike_type", "member_type", "starting_time", "ending_time", "start_sid", "end_sid", "start_geom", "end_geom")


def od_pairs(trips: DataFrame) -> DataFrame:
    """start_sid, end_sid, trip_count; trips that return to their start do not count."""
    return trips.where("start_sid <> end_sid").groupBy("start_sid", "end_sid").agg(F.count(F.lit(1)).alias("trip_count"))


def numbered(pairs: DataFrame) -> DataFrame:
    """With od_id (1, 2, ... by start and end)."""
    return cuts.numbered(pairs, "od_id", "start_sid", "end_sid")


def top(pairs: DataFrame, n: int) -> DataFrame:
    """The n pairs with most trips, ties by stations; all if n is 0."""
    return pairs.orderBy(F.desc("trip_count"), "start_sid", "end_sid").limit(n) if n else pairs


def page(pairs: DataFrame, size: int, number: int) -> DataFrame:
    """One page of pairs by od_id; pages count from 0."""
    return pairs.orderBy("od_id").offset(size * number).limit(size)


def combinations(pairs: DataFrame, snapped: DataFrame) -> DataFrame:
    """od_id, source, target, trip_count of pairs whose stations have different vertices. snapped: sid, vertex."""
    a = snapped.select(F.col("sid").alias("start_sid"), F.col("vertex").alias("source"))
    b = snapped.select(F.col("sid").alias("end_sid"), F.col("vertex").alias("target"))
    joined = pairs.join(a, "start_sid").join(b, "end_sid")
    return joined.where("source is not null and target is not null and source <> target").select("od_id", "source", "target", "trip_count")


def summary(trips: DataFrame) -> DataFrame:
    """Counts and the first and last day, in one row. A pair with a null counts as a pair."""
    return trips.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_distinct("start_sid").alias("start_stations"),
        F.count_distinct(F.struct("start_sid", "end_sid")).alias("pairs"),
        F.to_date(F.min("starting_time")).alias("first_day"),
        F.to_date(F.max("starting_time")).alias("last_day"),
    )
