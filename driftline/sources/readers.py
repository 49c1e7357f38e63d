"""Readers. Everything goes through Spark's file sources, so paths may lie in any store Spark can reach."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions import geo
from driftline.functions.geo import LINE, POINT

#: Columns of a raw trip, all read as text. The names in the public files.
TRIP_COLUMNS = (
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id", "end_station_name",
    "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first path (or glob) that matches something."""
    for path in candidates:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {candidates} exists")


def normalised_header(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*(c.strip().lower() for c in df.columns))


def files(spark: SparkSession, path: str, name_like: str) -> list[str]:
    """Files under a path (or glob), sorted, whose names match; hidden ones and those that begin with "._" or "_" are left out."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(p) or []:
        each = fs.listFiles(found.getPath(), True)
        while each.hasNext():
            f = each.next().getPath()
            if fnmatchcase(f.getName(), name_like) and f.getName()[0] not in "._":
                out.append(f.toString())
    return sorted(out)


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names in the first line of a file, stripped and in lower case."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p), "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return tuple(c.strip().lower() for c in next(csv.reader([line.lstrip("\ufeff")]), []))


def csv_trips(spark: SparkSession, path: str, name_like: str = "*.csv") -> DataFrame:
    """Raw trips of all files under path whose names match, all columns text, with the file's name (source_file). Columns are
    found by the names in each file's own first line, so files may order them differently; expected ones that a file lacks are null.

    The driver reads one line a file; files with the same first line are one scan. No file is an error.
    """
    names = files(spark, path, name_like)
    if not names:
        raise FileNotFoundError(f"no {name_like} under {path}")
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: header(spark, f), names))
    out = None
    for own in sorted(set(headers)):
        schema = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(own))])
        df = spark.read.option("header", True).schema(schema).csv([f for f, h in zip(names, headers, strict=True) if h == own])
        columns = [(F.col(f"_{own.index(c)}") if c in own else F.lit(None).cast("string")).alias(c) for c in TRIP_COLUMNS]
        df = df.select(*columns, F.col("_metadata.file_name").alias("source_file"))
        out = df if out is None else out.unionByName(df)
    return out


def zipped_csv(spark: SparkSession, path: str, prefixes: tuple[str, ...] = ("",)) -> DataFrame:
    """Raw trips of the CSV members (also of zips inside zips) whose names begin with one of the prefixes and not with "__".
    A zip is read by one task; its members are streamed."""

    def members(data: bytes) -> Iterator[tuple[str, zipfile.ZipFile]]:
        z = zipfile.ZipFile(io.BytesIO(data))
        for name in sorted(z.namelist()):
            base = name.rsplit("/", 1)[-1]
            if name.startswith("__") or base.startswith("._"):
                continue
            if name.lower().endswith(".zip"):
                yield from members(z.read(name))
            elif name.lower().endswith(".csv") and base.startswith(prefixes):
                yield name, z

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                for name, z in members(data):
                    with z.open(name) as f:
                        for part in pd.read_csv(f, dtype=str, chunksize=50_000):
                            part.columns = [c.strip().lower() for c in part.columns]
                            yield part.reindex(columns=TRIP_COLUMNS).astype(object).where(lambda d: d.notna(), None).assign(source_file=name.rsplit("/", 1)[-1])

    schema = ", ".join(f"{c} string" for c in (*TRIP_COLUMNS, "source_file"))
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("content").mapInPandas(read, schema)


_GEOMETRY = "struct<type:string, coordinates:string>"


def geojson(spark: SparkSession, path: str, properties: dict[str, str], kind: str, utm_zone: int | None = None) -> DataFrame:
    """Features with the given properties (new name -> name in the file; absent ones are null) and ``geom`` in degrees.

    kind: "point", "line" (multi-lines give a row a part) or "polygon" (multi-polygons give a row a part). Coordinates are
    taken as degrees whatever the file says, or as metres of a northern UTM zone and turned into degrees.
    """
    fields = ", ".join(f"`{v}`: string" for v in dict.fromkeys(properties.values()))
    schema = T.StructType.fromDDL(f"features array<struct<properties: struct<{fields}>, geometry: {_GEOMETRY}>>") if fields else None
    raw = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f"))
    raw = raw.withColumn("type", F.col("f.geometry.type")).withColumn("text", F.col("f.geometry.coordinates"))
    point = lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y"))
    line = lambda cs: F.transform(cs, point)
    rings = lambda rs: F.transform(rs, line)
    parsed = {d: F.from_json("text", "array<" * d + "double" + ">" * d) for d in (1, 2, 3, 4)}
    if kind == "point":
        parts = F.when(F.col("type") == "Point", F.array(point(parsed[1])))
    elif kind == "line":
        parts = F.when(F.col("type") == "LineString", F.array(line(parsed[2]))).when(F.col("type") == "MultiLineString", F.transform(parsed[3], line))
    else:
        parts = F.when(F.col("type") == "Polygon", F.array(rings(parsed[3]))).when(F.col("type") == "MultiPolygon", F.transform(parsed[4], rings))
    out = raw.select(*(F.col(f"f.properties.`{old}`").alias(new) for new, old in properties.items()), F.explode(parts).alias("geom"))
    if utm_zone is None:
        return out
    back = lambda p: geo.from_utm(p, utm_zone)
    turned = {"point": back(F.col("geom")), "line": F.transform("geom", back), "polygon": F.transform("geom", lambda r: F.transform(r, back))}
    return out.withColumn("geom", turned[kind])


def wkt_polygon(text):
    """Polygon column of POLYGON ((x y, ...), ...) text."""
    body = F.regexp_extract(text, r"(?i)^\s*(?:SRID=\d+;)?\s*POLYGON\s*\(\s*\((.*)\)\s*\)\s*$", 1)
    rings = F.split(body, r"\)\s*,\s*\(")
    xy = lambda p: F.split(F.trim(p), r"\s+")
    return F.transform(rings, lambda r: F.transform(F.split(r, ","), lambda p: F.struct(F.get(xy(p), 0).cast("double").alias("x"), F.get(xy(p), 1).cast("double").alias("y"))))


def wkt_polygons(text):
    """Array of polygons of POLYGON or MULTIPOLYGON text; null for anything else."""
    body = F.regexp_extract(text, r"(?i)^\s*(?:SRID=\d+;)?\s*MULTIPOLYGON\s*\(\s*(.*)\)\s*$", 1)
    parts = F.transform(F.split(body, r"(?<=\))\s*,\s*(?=\(\s*\()"), lambda p: wkt_polygon(F.concat(F.lit("POLYGON "), p)))
    return F.when(text.rlike(r"(?i)^\s*(SRID=\d+;)?\s*MULTIPOLYGON"), parts).when(text.rlike(r"(?i)^\s*(SRID=\d+;)?\s*POLYGON"), F.array(wkt_polygon(text)))


def wkb_line(column):
    """LineString column of hex WKB (or EWKB) text; null for anything else, or under two points."""
    import struct

    def one(text):
        try:
            data = bytes.fromhex(text)
            order = "<" if data[0] == 1 else ">"
            (kind,) = struct.unpack_from(order + "I", data, 1)
            at = 9 if kind & 0x20000000 else 5
            size = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
            (n,) = struct.unpack_from(order + "I", data, at)
            if kind & 0xFF != 2 or n < 2:
                return None
            v = struct.unpack_from(f"{order}{n * size}d", data, at + 4)
            return [{"x": v[k], "y": v[k + 1]} for k in range(0, n * size, size)]
        except (ValueError, TypeError, IndexError, struct.error):
            return None

    return F.pandas_udf(lambda s: s.map(one), LINE)(column)


def in_box(df: DataFrame, column: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """Rows whose point lies in the box: the clip of a raw extract."""
    return df.where(F.col(f"{column}.x").between(west, east) & F.col(f"{column}.y").between(south, north))


__all__ = ["LINE", "POINT", "TRIP_COLUMNS", "csv_trips", "exists", "files", "first_existing", "geojson", "header", "in_box", "normalised_header", "wkb_line", "wkt_polygon", "wkt_polygons", "zipped_csv"]
