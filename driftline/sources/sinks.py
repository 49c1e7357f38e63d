"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.sources.readers import exists


def parquet(df: DataFrame, path: str, schema: dict[str, str] | None = None, mode: str = "overwrite") -> None:
    """df with the given columns cast to the given types; mode "ignore" leaves files that are there."""
    if schema:
        df = df.select(*(F.col(c).cast(t).alias(c) for c, t in schema.items()))
    df.write.mode(mode).parquet(path)


def append_valid(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def once(df: DataFrame, path: str) -> bool:
    """Write unless the path holds something already; whether it was written."""
    if exists(df.sparkSession, path):
        return False
    df.write.parquet(path)
    return True


def by_day(df: DataFrame, path: str, day: str = "day", order: str = "t0", rows: int = 2048, salt: int = 1) -> None:
    """Files partitioned by day, rows in each file in order, small row groups so that a time window reads few of them.

    ``salt`` above 1 spreads a day over so many files.
    """
    keys = [F.col(day)] + ([F.pmod(F.xxhash64(order), F.lit(salt))] if salt > 1 else [])
    (
        df.repartition(*keys)
        .sortWithinPartitions(day, order)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(rows))
        .partitionBy(day)
        .parquet(path)
    )


def coordinates(line: Column) -> Column:
    return F.transform(line, lambda p: F.array(p["x"], p["y"]))


def feature(geom: Column, kind: str, properties: list[str]) -> Column:
    """GeoJSON text of one feature; kind is Point or LineString."""
    at = F.array(geom["x"], geom["y"]) if kind == "Point" else coordinates(geom)
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit(kind).alias("type"), at.alias("coordinates")).alias("geometry")))


def geojson_lines(df: DataFrame, path: str, geom: str = "geom", kind: str = "LineString") -> None:
    """One feature a line (newline-delimited GeoJSON), in as many files as there are partitions."""
    properties = [c for c in df.columns if c != geom]
    df.select(feature(F.col(geom), kind, properties).alias("value")).write.mode("overwrite").text(path)


def geojson_document(df: DataFrame, geom: str = "geom", kind: str = "LineString", order: str | None = None) -> DataFrame:
    """One row, one column ``value``: a FeatureCollection. For results that fit one row."""
    properties = [c for c in df.columns if c != geom]
    rows = df.select(F.struct(F.col(order) if order else F.lit(0), feature(F.col(geom), kind, properties).alias("f")).alias("x"))
    listed = rows.agg(F.array_sort(F.collect_list("x")).alias("x"))
    return listed.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("x", lambda v: v["f"]), ","), F.lit("]}")).alias("value"))


def compact_routes(routes: DataFrame, trips: DataFrame, meta: DataFrame, digits: int = 5) -> DataFrame:
    """One row of JSON: the meta columns, routes as [[[x, y], ...], ...] and trips as [[route index, t0, dur], ...] by t0.

    routes: route_id (0, 1, ...), geom; trips: route_id, t0, dur. For what fits one row; large results go to by_day.
    """
    r = routes.agg(F.array_sort(F.collect_list(F.struct("route_id", F.transform("geom", lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits))).alias("g")))).alias("r"))
    t = trips.agg(F.array_sort(F.collect_list(F.struct("t0", "route_id", "dur"))).alias("t"))
    row = F.struct(*meta.columns, F.transform("r", lambda x: x["g"]).alias("routes"), F.transform("t", lambda x: F.array(x["route_id"].cast("double"), x["t0"], x["dur"])).alias("trips"))
    return meta.crossJoin(r).crossJoin(t).select(F.to_json(row).alias("value"))


def json_file(row: DataFrame, path: str) -> None:
    """A table of one row, such as a run's metadata, as one JSON document in one file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def written_bytes(spark, path: str) -> int:
    """Size of the files under a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
