"""From raw rows to valid trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions.text import number, station_id, timestamp


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a given order. Ties are the caller's to break."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def valid_duration(start: Column, end: Column, hours: int = Settings.max_trip_hours) -> Column:
    """End after start, and at most ``hours`` later. False where either is null."""
    return F.coalesce((end > start) & (end - start <= F.make_dt_interval(F.lit(0), F.lit(hours))), F.lit(False))


def duration_class(start: Column, end: Column, hours: int = Settings.max_trip_hours) -> Column:
    return (
        F.when(start.isNull() | end.isNull(), "missing").when(end <= start, "not after start").when(end - start > F.make_dt_interval(F.lit(0), F.lit(hours)), "too long").otherwise("valid")
    )


def typed(raw: DataFrame) -> DataFrame:
    """Raw trips with station codes, numbers and timestamps; what does not parse is null."""
    return raw.select(
        "ride_id",
        F.col("rideable_type").alias("bike_type"),
        F.col("member_casual").alias("member_type"),
        timestamp(F.col("started_at")).alias("starting_time"),
        timestamp(F.col("ended_at")).alias("ending_time"),
        *(station_id(F.col(f"{w}_station_id")).alias(f"{w}_station_id") for w in ("start", "end")),
        *(F.col(f"{w}_station_name") for w in ("start", "end")),
        *(number(F.col(f"{w}_{c}")).alias(f"{w}_{c}") for w in ("start", "end") for c in ("lat", "lng")),
        *(F.col(c) for c in raw.columns if c == "source_file"),
    )


def valid(trips: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Trips with both stations, names, places and a valid duration; of rows that repeat a ride_id the first by start, end and file."""
    needed = [f"{w}_{c}" for w in ("start", "end") for c in ("station_id", "station_name", "lat", "lng")]
    kept = trips.na.drop(subset=needed).where(valid_duration(F.col("starting_time"), F.col("ending_time"), s.max_trip_hours))
    order = [F.col(c).asc() for c in ("starting_time", "ending_time", *([] if "source_file" not in trips.columns else ["source_file"]), "start_station_id", "end_station_id")]
    return first_per_key(kept, ["ride_id"], order)


def in_area(df: DataFrame, lat: str, lng: str, s: Settings = Settings()) -> DataFrame:
    return df.where(F.col(lat).between(s.min_lat, s.max_lat) & F.col(lng).between(s.min_lng, s.max_lng))
