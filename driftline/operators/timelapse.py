"""Animation tables: routes with dense ids, trips on a short clock, samples, and vertex times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import codec, geo, timing
from driftline.functions.text import seconds
from driftline.operators import cuts


def routes(od_routes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """route_id (1, 2, ... by od_id), od_id, geom of routes with two vertices at least, simplified so that none meets itself anew."""
    kept = od_routes.where("route_geom is not null").where(geo.n_points(F.col("route_geom")) >= 2)
    ids = cuts.numbered(kept.select("od_id").distinct(), "route_id", "od_id")
    simple = kept.join(ids, "od_id").select("route_id", "od_id", codec.simplified(F.col("route_geom"), s.simplify_deg, topology=True).alias("geom"))
    return simple.withColumn("geom", geo.drop_repeats(F.col("geom")))


def points(rts: DataFrame) -> DataFrame:
    return rts.select("route_id", F.posexplode("geom").alias("seq", "p")).select("route_id", (F.col("seq") + 1).alias("seq"), F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))


def vertex_summary(rts: DataFrame) -> DataFrame:
    n = geo.n_points(F.col("geom"))
    return rts.agg(F.count(F.lit(1)).alias("routes"), F.sum(n).alias("vertices"), F.avg(n).cast("decimal(8,1)").alias("mean_vertices"))


def period(trips: DataFrame, s: Settings = Settings()) -> DataFrame:
    """t_min, t_max, span_s over all trips from the start date on, routed or not."""
    kept = trips.where(F.col("starting_time") >= F.lit(s.start_date).cast("timestamp_ntz"))
    b = kept.agg(F.min("starting_time").alias("t_min"), F.max("ending_time").alias("t_max"))
    return b.withColumn("span_s", seconds(F.col("t_min"), F.col("t_max")))


def clocked(trips: DataFrame, pairs: DataFrame, rts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """ride_id, route_id, t0, dur (float), day of each trip of a pair that has a route."""
    keys = pairs.join(rts.select("od_id", "route_id"), "od_id").select("start_sid", "end_sid", "route_id")
    kept = trips.where(F.col("starting_time") >= F.lit(s.start_date).cast("timestamp_ntz")).where("ending_time is not null")
    rows = kept.join(keys, ["start_sid", "end_sid"]).crossJoin(F.broadcast(period(trips, s)))  # one row
    return rows.select(
        "ride_id",
        "route_id",
        timing.on_clock(F.col("t_min"), F.col("starting_time"), F.col("span_s"), s.clock_s).cast("float").alias("t0"),
        timing.clock_length(F.col("starting_time"), F.col("ending_time"), F.col("span_s"), s).cast("float").alias("dur"),
        F.to_date("starting_time").alias("day"),
    )


def meta(trips: DataFrame, n_routes: DataFrame, n_trips: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row: period_start, period_end, clock length, numbers of routes and trips."""
    p = period(trips, s).select(F.col("t_min").alias("period_start"), F.col("t_max").alias("period_end"), F.lit(s.clock_s).alias("anim_duration_s"))
    return p.crossJoin(n_routes.agg(F.count(F.lit(1)).alias("n_routes"))).crossJoin(n_trips.agg(F.count(F.lit(1)).alias("n_trips")))


def first_trips(trips: DataFrame, most: int) -> DataFrame:
    """The first trips by start and ride_id; all if most is 0."""
    return trips.orderBy("starting_time", "ride_id").limit(most) if most else trips


def change_points(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a table ordered by key and order at which the key differs from the row before: the first of each run, with its
    number of rows. Sorted by key, a run is a group, so no window over the whole table is needed."""
    return rows.groupBy(key).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))


def sampled(tl: DataFrame, buckets: int = Settings.buckets, slices: int = 64) -> DataFrame:
    """With samp: the place of a trip within its day, by t0 and ride_id, modulo the number of buckets.

    A day is ordered in ``slices`` stretches of t0, each with the number of trips before it, so that no task holds a
    whole day.
    """
    cut_ = F.floor(F.col("t0") / F.lit(Settings.clock_s / (92 * slices))).alias("slice")
    rows = tl.withColumn("slice", cut_)
    counts = rows.groupBy("day", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("day").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("day", "slice", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("day", "slice").orderBy("t0", "ride_id")) - 1
    rows = rows.withColumn("place", place).join(counts, ["day", "slice"])
    return rows.withColumn("samp", ((F.col("place") + F.col("before")) % buckets).cast("short")).drop("slice", "place", "before")


def export(tl: DataFrame, rts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """t0, dur, geom (polyline text), samp, day of each trip: routes are encoded once each, then joined in."""
    text = rts.select("route_id", codec.polyline(F.col("geom")).alias("geom")).where("geom is not null")
    return sampled(tl, s.buckets).join(text, "route_id").select("t0", "dur", "geom", "samp", "day")


def playback(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """rows (geom as polyline text, t0) with the decoded line, and the time at each of its vertices; rows with fewer than two
    vertices are dropped."""
    lines = rows.withColumn("line", codec.from_polyline(F.col("geom"))).where(geo.n_points(F.col("line")) >= 2)
    return lines.withColumn("times", timing.vertex_times(F.col("line"), F.col("t0").cast("double"), s))


def packed(rows: DataFrame, order: str) -> DataFrame:
    """One row for a window that fits it: start_indices (one more than rows), positions (flat x, y) and timestamps."""
    got = rows.agg(F.array_sort(F.collect_list(F.struct(order, "line", "times"))).alias("r"))
    lines = F.transform("r", lambda x: x["line"])
    starts = F.aggregate(lines, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + F.size(x))))
    flat = F.flatten(F.transform(F.flatten(lines), lambda p: F.array(p["x"].cast("float"), p["y"].cast("float"))))
    return got.select(F.size("r").alias("length"), starts.alias("start_indices"), flat.alias("positions"), F.transform(F.flatten(F.transform("r", lambda x: x["times"])), lambda t: t.cast("float")).alias("timestamps"))


def windowed(spark, path: str, day: str, t_from: float, t_to: float, below: int = Settings.buckets) -> DataFrame:
    """Trips of one day whose t0 lies in a window, thinned to samples below a bound; day prunes folders, t0 row groups."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("day") == F.lit(day).cast("date")).where(F.col("t0").between(F.lit(t_from).cast("float"), F.lit(t_to).cast("float"))).where(F.col("samp") < below)
