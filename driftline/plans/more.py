"""More example queries: loading and cleaning, stations, topology, route lines, attribution, animation and files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions import codec, geo, text, timing
from driftline.operators import clean, cuts, flows, gates, graph, network, spatial, timelapse, trips
from driftline.operators import stations as stations_
from driftline.plans import catalogue as cat
from driftline.plans import fixtures as fx
from driftline.plans import views
from driftline.plans.catalogue import query
from driftline.sources import readers, sinks, tiles

#: Parts of names of structures, and patterns that are searched in part names.
PARTS, PATTERNS = ("BRIDGE", "BRG"), ("BOLT|ROD", "^HOT", "NO SUCH")


def _place(spark, name: str) -> str:
    return f"{cuts.folder(spark)}/{name}-{uuid.uuid4().hex}"


# A: loading and cleaning


def raw_text(spark, sf) -> DataFrame:
    """Trips as a file has them: all columns text, some of them no number or time, one end in seven without a station."""
    t = fx.raw_trips(spark, sf)
    out = [F.concat(F.lit("r"), (F.col("ride_id") - F.col("ride_id") % 3).cast("string")).alias("ride_id"), F.col("bike_type").alias("rideable_type")]
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    out += [stamp("starting_time").alias("started_at"), F.coalesce(stamp("ending_time"), F.lit("none")).alias("ended_at")]
    for w in ("start", "end"):
        k = F.col(f"{w}_sid")
        out.append(F.when(F.col("ride_id") % 7 > 0, F.concat(F.lit("Stop "), k.cast("string"))).alias(f"{w}_station_name") if w == "end" else F.concat(F.lit("Stop "), k.cast("string")).alias(f"{w}_station_name"))
        out.append(F.concat(F.lit(" SYS0"), k.cast("string")).alias(f"{w}_station_id"))
        out.append(F.when(F.col("ride_id") % 11 > 0, (F.lit(40) + k / 64).cast("string")).otherwise("x").alias(f"{w}_lat") if w == "start" else (F.lit(40) + k / 64).cast("string").alias(f"{w}_lat"))
        out.append((F.lit(-74) + k / 128).cast("string").alias(f"{w}_lng"))
    return t.select(*out, F.lit("member").alias("member_casual"))


def _typed(spark, sf) -> DataFrame:
    return clean.typed(raw_text(spark, sf))


@query
def clean_typed(spark, sf):
    """Text to codes, numbers and times; what does not parse is null."""
    return _typed(spark, sf).groupBy("start_station_id").agg(F.count(F.lit(1)).alias("trips"), F.count("ending_time").alias("ended"), F.count("start_lat").alias("placed"), F.sum("end_lat").alias("lat"), F.max(text.iso(F.col("starting_time"))).alias("last"))


@query
def clean_valid(spark, sf):
    """Complete trips of a valid length, one a ride id."""
    out = clean.valid(_typed(spark, sf))
    return out.select("ride_id", "bike_type", text.iso(F.col("starting_time")).alias("started"), "start_station_id", "end_station_name", "start_lat", "end_lng")


@query
def clean_area(spark, sf):
    return clean.in_area(_typed(spark, sf), "start_lat", "start_lng").groupBy("bike_type").agg(F.count(F.lit(1)).alias("trips"))


@query
def station_table(spark, sf):
    """Stations from the ends of valid trips: name and place most often seen, numbered by id."""
    out = stations_.stations(clean.valid(_typed(spark, sf)))
    return out.select("sid", "station_id", "station_name", F.col("geom.x").alias("lng"), F.col("geom.y").alias("lat"), "count")


@query
def trips_between(spark, sf):
    valid = clean.valid(_typed(spark, sf))
    return trips.between_stations(valid, stations_.stations(valid)).groupBy("start_sid", "end_sid").agg(F.count(F.lit(1)).alias("trips"))


@query
def csv_columns(spark, sf):
    """Two sets of files whose columns differ in order and number, read back by their headers."""
    path, rows = _place(spark, "csv"), raw_text(spark, sf)
    head = F.col("started_at") < "2024-01-15"
    rows.where(head).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{path}/a")
    rows.where(~head).select(*[F.col(c).alias(f" {c.upper()} ") for c in reversed(rows.columns) if c != "member_casual"], F.lit("q").alias("other")).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{path}/b")
    got = readers.csv_trips(spark, path)
    return got.groupBy("start_station_id", "member_casual").agg(F.count(F.lit(1)).alias("trips"), F.count("end_station_name").alias("ends"), F.max("started_at").alias("last"), F.min("ride_id").alias("first"), F.substring(F.min("source_file"), 1, 4).alias("file"))


@query
def parquet_kept(spark, sf):
    """Written with a fixed schema; a second write leaves it, an append adds to it."""
    path, rows = _place(spark, "kept"), fx.valid_trips(spark, sf)
    sinks.parquet(rows, path, {"ride_id": "string", "start_sid": "long"}, mode="ignore")
    sinks.parquet(rows.limit(1), path, {"ride_id": "string", "start_sid": "long"}, mode="ignore")
    again = sinks.once(rows, path)
    sinks.append_valid(rows.where("start_sid = end_sid").select(F.col("ride_id").cast("string"), F.col("start_sid").cast("long")), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.sum("start_sid").alias("sids"), F.lit(again).alias("written_again"), F.lit(sinks.written_bytes(spark, path) > 0).alias("on_disk"))


# B: stations, areas, checks


def _tagged(spark, sf) -> DataFrame:
    return stations_.tagged(fx.stations(spark, sf).drop("borough"), fx.boxes(spark))


@query
def stations_per_area(spark, sf):
    return stations_.per_area(_tagged(spark, sf))


@query
def stations_invalid(spark, sf):
    """Stations without a place, where every ninth has none."""
    bad = F.when(F.col("sid") % 9 > 0, F.col("geom"))
    return stations_.invalid(fx.stations(spark, sf).withColumn("geom", bad)).select("sid")


@query
def rows_observed(spark, sf):
    """Rows counted by the write that goes over them."""
    out = []
    for name, df in (("valid trips", fx.valid_trips(spark, sf)), ("edges", fx.edges(spark, sf))):
        seen_by, seen = gates.observed(df, name)
        seen_by.write.format("noop").mode("overwrite").save()
        out.append((name, seen.get["rows"]))
    return spark.createDataFrame(out, "name string, rows long")


@query
def sql_views(spark, sf):
    """Engine tables joined in SQL."""
    with views.named(spark, trips_=fx.valid_trips(spark, sf), stations_=fx.stations(spark, sf)):
        return spark.sql("select borough, count(*) as trips from trips_ join stations_ on start_sid = sid group by borough")


@query
def points_in_box(spark, sf):
    return readers.in_box(fx.lonlat(spark, sf), "geom", -74.26, 40.69, -73.99, 40.92).select("id")


@query
def tile_keys(spark, sf):
    lines = fx.edges(spark, sf).select("id", cat._degrees(F.col("geom")).alias("geom"))
    return tiles.by_tile(lines, "geom", (12, 15)).groupBy("zoom", "tx", "ty").agg(F.count(F.lit(1)).alias("lines"))


# C: network


def _lines(spark, sf) -> DataFrame:
    """Edges as street lines: a type (text, some missing), a mark, a name; every seventh without length."""
    e = fx.edges(spark, sf)
    kind = F.when(F.col("id") % 13 > 0, (F.col("id") % 16).cast("string"))
    name = F.when(F.col("id") % 5 == 0, F.concat(F.lit("Old bridge "), F.col("id").cast("string"))).when(F.col("id") % 5 < 4, F.concat(F.lit("Way "), F.col("id").cast("string")))
    geom = F.when(F.col("id") % 7 == 0, F.array(F.get("geom", 0), F.get("geom", 0))).otherwise(F.col("geom"))
    return e.select("id", "source", "target", kind.alias("rw_type"), F.when(F.col("id") % 2 == 0, "V").alias("nonped"), name.alias("street_name"), geom.alias("geom_m"))


@query
def lines_rideable(spark, sf):
    return network.rideable(_lines(spark, sf)).select("id", "rw_type")


@query
def lines_usable(spark, sf):
    return network.usable(_lines(spark, sf)).select("id")


@query
def line_ids(spark, sf):
    """Ids of their own for lines, by name and place."""
    rows = fx.table(spark, sf, "customer").select("c_mktsegment", "c_name")
    return network.identified(rows, "c_mktsegment", "c_name")


@query
def topology_edges(spark, sf):
    """Vertices from the ends of lines; ends at the same place are one vertex."""
    e, _ = graph.topology(network.usable(_lines(spark, sf)).select("id", "geom_m"), 0.0)
    return e.select("id", "source", "target", F.round("cost", 6).alias("cost"), F.round("reverse_cost", 6).alias("reverse_cost"))


@query
def topology_vertices(spark, sf):
    _, v = graph.topology(network.usable(_lines(spark, sf)).select("id", "geom_m"), 0.0)
    return v.select("id", F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))


@query
def segments_named(spark, sf):
    return network.named(fx.table(spark, sf, "part"), "p_name", PATTERNS)


def _snapped_areas(spark, sf) -> DataFrame:
    return fx.snapped(spark, sf).join(fx.stations(spark, sf).select("sid", F.col("borough").cast("string")), "sid")


@query
def area_connectivity(spark, sf):
    return network.connectivity(cat._short(spark, sf), _snapped_areas(spark, sf))


@query
def areas_missing(spark, sf):
    return network.areas_gate(cat._short(spark, sf), _snapped_areas(spark, sf), ("0", "1", "2", "nowhere"))


@query
def component_sizes(spark, sf):
    return graph.sizes(graph.components(cat._short(spark, sf), "source", "target"))


# D: routes and flows


@query
def route_lines(spark, sf):
    """Route lines strung together in path order: how many edges and vertices, where they begin and end, and what they sum to."""
    found, combos = cat._paths(spark, sf)
    out = flows.routes(found, combos, fx.edges(spark, sf), oriented=True)
    g = F.col("route_geom")
    return out.select("od_id", "trip_count", "edge_count", F.size(g).alias("vertices"), geo.start_point(g)["x"].alias("from_x"), geo.end_point(g)["y"].alias("to_y"), F.aggregate(g, F.lit(0.0), lambda s, p: s + p["x"]).alias("sum_x"))


@query
def path_steps(spark, sf):
    """Steps of every path, without the row that ends it."""
    found, combos = cat._paths(spark, sf)
    rows = graph.path_rows(found, combos)
    return rows.groupBy("od_id").agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("edge") > 0).cast("int")).alias("edges"), F.max("seq").alias("last"), F.max_by("node", "seq").alias("at"))


@query
def routing_metrics(spark, sf):
    found, combos = cat._paths(spark, sf)
    on_edges = flows.with_attributes(flows.edge_flows(found, combos), _lines(spark, sf), ["street_name"])
    routes = combos.join(found, ["source", "target"]).select("od_id", "trip_count")
    return network.routing_metrics(routes, on_edges, fx.stations(spark, sf).select("sid", "borough"), fx.od(spark, sf), PARTS)


@query
def flow_keywords(spark, sf):
    rows = cat._edge_trips(spark, sf).select("id", "total_trips").join(_lines(spark, sf).select("id", "street_name"), "id")
    return flows.keyword_trips(rows, "street_name", PARTS)


@query
def flow_on_all(spark, sf):
    """Every centreline, with zero where no flow lies near it."""
    return flows.on_all(flows.total(cat._assigned(spark, sf)), cat._centrelines(spark, sf).select("cl_id"))


@query
def flow_dropped(spark, sf):
    out = flows.dropped_percent(cat._edge_trips(spark, sf), cat._assigned(spark, sf))
    return out.select(F.col("before").cast("long").alias("before"), F.col("after").cast("long").alias("after"), F.round("dropped_percent", 9).alias("dropped_percent"))


@query
def flow_positive(spark, sf):
    net = cat._edge_trips(spark, sf).select("id", (F.col("total_trips") - 50).alias("total_trips"))
    return flows.positive(net)


# E: animation and files


def _routes(spark, sf) -> DataFrame:
    """Edges as routes in degrees, each vertex twice."""
    e = fx.edges(spark, sf).select(F.col("id").alias("od_id"), cat._degrees(F.col("geom")).alias("g"))
    return e.select("od_id", F.array(F.get("g", 0), F.get("g", 0), F.get("g", 1), F.get("g", 1)).alias("route_geom"))


@query
def tl_routes(spark, sf):
    out = timelapse.routes(_routes(spark, sf))
    return out.select("route_id", "od_id", F.size("geom").alias("vertices"))


@query
def tl_points(spark, sf):
    rts = fx.edges(spark, sf).select(F.col("id").alias("route_id"), "geom")
    return timelapse.points(rts)


@query
def tl_vertices(spark, sf):
    rts = _routes(spark, sf).select("od_id", F.when(F.col("od_id") % 2 == 0, geo.drop_repeats(F.col("route_geom"))).otherwise(F.col("route_geom")).alias("geom"))
    return timelapse.vertex_summary(rts).withColumn("mean_vertices", F.col("mean_vertices").cast("double"))


@query
def tl_runs(spark, sf):
    """First vertex and number of vertices of each route, where the sorted route ids change."""
    rts = fx.edges(spark, sf).select(F.col("source").alias("route_id"), "id")
    return timelapse.change_points(rts, "route_id", "id")


@query
def tl_first_trips(spark, sf):
    """The report of the first hundred trips."""
    return timelapse.first_trips(fx.valid_trips(spark, sf), 100).select("ride_id", text.iso(F.col("starting_time")).alias("started"))


@query
def tl_rounded(spark, sf):
    """Both ends of a trip on a clock of two decimals."""
    t = fx.valid_trips(spark, sf).where(F.col("starting_time") >= F.lit(cat.CLOCK.start_date).cast("timestamp_ntz"))
    rows = t.crossJoin(F.broadcast(timelapse.period(t, cat.CLOCK)))  # one row
    t0, dur = timing.clock_rounded(F.col("t_min"), F.col("starting_time"), F.col("ending_time"), F.col("span_s"), cat.CLOCK)
    return rows.groupBy(F.to_date("starting_time").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("trips"), F.sum(F.rint(t0 * 100).cast("long")).alias("t0"), F.sum(F.rint(dur * 100).cast("long")).alias("dur"))


@query
def tl_export(spark, sf):
    """Animation rows with their line as text: rows, samples and characters of each day."""
    _, rts, tl = cat._tl(spark, sf)
    lines = rts.select("route_id", cat._degrees(F.col("geom")).alias("geom"))
    out = timelapse.export(tl, lines, cat.CLOCK)
    ends = codec.from_polyline(F.col("geom"))
    return out.groupBy(cat._day("day").alias("day")).agg(F.count(F.lit(1)).alias("trips"), F.sum("samp").alias("samples"), F.sum(F.rint((ends[0]["x"] + 74) * 1e6).cast("long")).alias("from_x"))


@query
def route_index(spark, sf):
    """Trips with their route as a place in the list of routes, which counts from 0."""
    _, rts, _ = cat._tl(spark, sf)
    t = fx.valid_trips(spark, sf).join(rts.select("start_sid", "end_sid", (F.col("route_id") - 1).alias("route")), ["start_sid", "end_sid"])
    return t.groupBy("route").agg(F.count(F.lit(1)).alias("trips"))


@query
def coords_rounded(spark, sf):
    aside = F.transform("geom", lambda p: geo.point(p["x"] + 1.3, p["y"] + 1.3))  # so that no place lies halfway
    e = fx.edges(spark, sf).select("id", F.explode(geo.rounded(cat._degrees(aside), 5)).alias("p"))
    return e.groupBy("id").agg(F.sum(F.rint(F.col("p.x") * 1e5).cast("long")).alias("x"), F.sum(F.rint(F.col("p.y") * 1e5).cast("long")).alias("y"))


@query
def repeats_dropped(spark, sf):
    return _routes(spark, sf).select("od_id", F.size(geo.drop_repeats(F.col("route_geom"))).alias("vertices"))


@query
def geojson_features(spark, sf):
    e = fx.edges(spark, sf).select("id", "source", "geom")
    return e.select("id", sinks.feature(F.col("geom"), "LineString", ["id", "source"]).alias("feature"))


@query
def geojson_read(spark, sf):
    """Areas written as one document and read back, multi-polygons as a row a part, null where a property is absent."""
    path, st = _place(spark, "geojson"), fx.stations(spark, sf)
    sinks.geojson_document(st.select("sid", "geom"), "geom", "Point", "sid").write.text(path)
    got = readers.geojson(spark, path, {"sid": "sid", "name": "name"}, "point")
    return got.select(F.col("sid").cast("long").alias("sid"), F.col("name").isNull().alias("unnamed"), F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))


@query
def wkt_areas(spark, sf):
    """A square around every point as text, two of them for even ids, parsed."""
    p = fx.points(spark, sf)
    at = lambda dx, dy: F.concat_ws(" ", (F.col("x") + dx).cast("string"), (F.col("y") + dy).cast("string"))
    ring = lambda o: F.concat(F.lit("(("), F.concat_ws(", ", at(o, o), at(o + 10, o), at(o + 10, o + 10), at(o, o)), F.lit("))"))
    wkt = F.when(F.col("id") % 2 == 0, F.concat(F.lit("MULTIPOLYGON ("), ring(0), F.lit(", "), ring(50), F.lit(")"))).otherwise(F.concat(F.lit("POLYGON "), ring(0)))
    got = p.select("id", readers.wkt_polygons(wkt).alias("a"))
    flat = F.flatten(F.flatten("a"))
    return got.select("id", F.size("a").alias("polygons"), F.size(flat).alias("vertices"), F.aggregate(flat, F.lit(0.0), lambda s, v: s + v["x"]).alias("sum_x"))


@query
def metadata_file(spark, sf):
    """A run's metadata as one JSON document, with the number of sample buckets, read back as text."""
    t, rts, tl = cat._tl(spark, sf)
    m = timelapse.meta(t, rts, tl, cat.CLOCK)
    m = m.select(text.iso(F.col("period_start")).alias("period_start"), text.iso(F.col("period_end")).alias("period_end"), "anim_duration_s", "n_routes", "n_trips", F.lit(cat.CLOCK.buckets).alias("samp_buckets"))
    path = _place(spark, "meta")
    sinks.json_file(m, path)
    return spark.read.text(path)


@query
def edges_in_areas(spark, sf):
    """Midpoints of edges, tagged with the area they lie in."""
    mids = flows.midpoints(cat._edge_trips(spark, sf), "geom_m").select("id", "mid")
    return spatial.tag_within(mids, fx.boxes(spark), "id", "mid").groupBy("area").agg(F.count(F.lit(1)).alias("edges"))
