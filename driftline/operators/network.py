"""The street network: which segments count, and whether the graph holds together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import geo
from driftline.operators import cuts, graph, spatial


def rideable(lines: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Without excluded road types and without type 3 that is marked as no street for vehicles ("V"); a missing type
    counts as 0, a missing mark as none."""
    kind, mark = F.coalesce(F.col("rw_type").try_cast("int"), F.lit(0)), F.coalesce("nonped", F.lit(""))
    return lines.withColumn("rw_type", kind).where(~F.col("rw_type").isin(*s.excluded_road_types) & ~((F.col("rw_type") == 3) & (mark == "V")))


def identified(lines: DataFrame, *order: str) -> DataFrame:
    """lines with an id: 1, 2, ... in the given order, which is total. Rows are numbered over ranges."""
    return cuts.numbered(lines, "id", *order)


def usable(lines: DataFrame, s: Settings = Settings(), geom: str = "geom_m") -> DataFrame:
    return lines.where(geo.is_line(F.col(geom), s.min_edge_m))


def network(lines: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(edges, vertices) of rideable, usable lines (id, rw_type, nonped, geom in degrees)."""
    metres = rideable(lines, s).withColumn("geom_m", geo.line_to_utm(F.col("geom")))
    return graph.topology(usable(metres, s), s.cluster_m)


def snap(st: DataFrame, vertices: DataFrame, geom: str = "geom_utm") -> DataFrame:
    """sid, vertex: the nearest vertex of each station."""
    return spatial.nearest_point(st, "sid", geom, vertices, "id", "geom").select("sid", F.col("target").alias("vertex"))


def connectivity(edges: DataFrame, snapped: DataFrame) -> DataFrame:
    """borough, stations, connected: of each area's stations those whose vertex is in the largest component. snapped: sid, vertex, borough."""
    inside = graph.largest(graph.components(edges, "source", "target")).select(F.col("node").alias("vertex"), F.lit(1).alias("in"))
    return snapped.join(inside, "vertex", "left").groupBy("borough").agg(F.count(F.lit(1)).alias("stations"), F.count("in").alias("connected"))


def areas_gate(edges: DataFrame, snapped: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Required areas of which no station's vertex is in the largest component: a hard gate wants none."""
    spark = edges.sparkSession
    got = connectivity(edges, snapped).where("connected > 0").select("borough")
    return spark.createDataFrame([(r,) for r in required], "borough string").join(got, "borough", "left_anti")


def named(lines: DataFrame, name: str, patterns: tuple[str, ...]) -> DataFrame:
    """pattern, segments: how many names hold each pattern (a regular expression, case ignored), zero included."""
    up = F.upper(F.coalesce(F.col(name), F.lit("")))
    sums = lines.agg(*(F.sum(F.when(up.rlike(p), 1).otherwise(0)).alias(f"p{i}") for i, p in enumerate(patterns)))
    rows = F.array(*(F.struct(F.lit(p).alias("pattern"), F.coalesce(f"p{i}", F.lit(0)).cast("long").alias("segments")) for i, p in enumerate(patterns)))
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def routing_metrics(routes: DataFrame, on_edges: DataFrame, st: DataFrame, pairs: DataFrame, parts: tuple[str, ...] = Settings.keywords) -> DataFrame:
    """One row: routes, routed trips, largest flow, routes between different areas, trips over named structures."""
    from driftline.operators.flows import keyword_trips

    a, b = (st.select(F.col("sid").alias(f"{w}_sid"), F.col("borough").alias(f"{w}_borough")) for w in ("start", "end"))
    across = routes.join(pairs.select("od_id", "start_sid", "end_sid"), "od_id").join(a, "start_sid").join(b, "end_sid")
    return (
        routes.agg(F.count(F.lit(1)).alias("routes"), F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trips"))
        .crossJoin(on_edges.agg(F.max("total_trips").alias("largest_flow")))
        .crossJoin(across.agg(F.coalesce(F.sum(F.when(F.col("start_borough") != F.col("end_borough"), 1)), F.lit(0)).alias("across_areas")))
        .crossJoin(keyword_trips(on_edges, "street_name", parts).select(F.col("trips").alias("structure_trips")))
    )
