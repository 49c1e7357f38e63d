"""The engine's example queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import codec, geo, text
from driftline.operators import clean, cuts, flows, gates, graph, profile, spatial, timelapse, trips
from driftline.operators import stations as stations_
from driftline.plans import fixtures as fx
from driftline.sources import sinks

#: Events begin in 2024.
CLOCK = Settings(start_date="2024-01-02")
CAP = 3000.0

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


# A: cleaning, pairs and profile


@query
def od_pairs(spark, sf):
    return trips.od_pairs(fx.valid_trips(spark, sf))


@query
def station_departures(spark, sf):
    return stations_.departures(fx.stations(spark, sf).select("sid", "borough"), fx.valid_trips(spark, sf))


@query
def trip_summary(spark, sf):
    out = trips.summary(fx.valid_trips(spark, sf))
    return out.withColumn("first_day", _day("first_day")).withColumn("last_day", _day("last_day"))


@query
def daily_volume(spark, sf):
    return profile.daily(fx.valid_trips(spark, sf)).withColumn("day", _day("day"))


@query
def daily_extremes(spark, sf):
    out = profile.extremes(profile.daily(fx.valid_trips(spark, sf)))
    return out.withColumn("mean", F.round("mean", 6)).withColumn("most_on", _day("most_on")).withColumn("least_on", _day("least_on"))


@query
def od_coverage(spark, sf):
    return profile.coverage(trips.od_pairs(fx.valid_trips(spark, sf)))


def _modes(spark, sf) -> DataFrame:
    ends = fx.valid_trips(spark, sf).select(F.explode(F.array("start_sid", "end_sid")).alias("sid"), "bike_type")
    return stations_.mode(ends, "sid", ["bike_type"])


@query
def station_mode(spark, sf):
    return _modes(spark, sf)


@query
def trip_dedup(spark, sf):
    rows = fx.raw_trips(spark, sf).select("ride_id", "bike_type", "start_sid")
    return clean.first_per_key(rows, ["bike_type", "start_sid"], [F.col("ride_id").asc()])


@query
def trip_validity(spark, sf):
    kind = clean.duration_class(F.col("starting_time"), F.col("ending_time"))
    return fx.raw_trips(spark, sf).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("trips"))


@query
def station_id_norm(spark, sf):
    k = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 6 == 0, F.concat(F.lit(" SYS0"), k)).when(F.col("c_custkey") % 6 == 1, F.concat(F.lit("JC"), k)).when(F.col("c_custkey") % 6 == 2, F.concat(F.lit("HB"), k, F.lit("x")))
    raw = raw.when(F.col("c_custkey") % 6 == 3, F.concat(F.lit("Lab - NYC "), k)).when(F.col("c_custkey") % 6 == 4, F.concat(k, F.lit(".04 ")))
    return fx.table(spark, sf, "customer").select("c_custkey", text.station_id(raw).alias("station_id"))


# B: joins, pages, gates


@query
def role_join(spark, sf):
    """Trips whose type is the most frequent one at both ends (a join on two keys, twice)."""
    dim = _modes(spark, sf).join(fx.stations(spark, sf).select("sid", "borough"), "sid").select("sid", "bike_type", "borough")
    a = dim.select(F.col("sid").alias("start_sid"), "bike_type", F.col("borough").alias("start_borough"))
    b = dim.select(F.col("sid").alias("end_sid"), "bike_type", F.col("borough").alias("end_borough"))
    return fx.valid_trips(spark, sf).join(a, ["start_sid", "bike_type"]).join(b, ["end_sid", "bike_type"]).select("ride_id", "start_borough", "end_borough")


@query
def od_semi(spark, sf):
    return fx.od(spark, sf).join(fx.combos(spark, sf).select("od_id"), "od_id", "left_semi").select("od_id", "start_sid", "end_sid", "trip_count")


@query
def station_anti(spark, sf):
    """Stations that no pair with more than one trip leaves."""
    busy = trips.od_pairs(fx.valid_trips(spark, sf)).where("trip_count > 1")
    return fx.stations(spark, sf).select("sid", "borough").join(busy, F.col("sid") == F.col("start_sid"), "left_anti")


@query
def od_topn(spark, sf):
    return trips.top(trips.od_pairs(fx.valid_trips(spark, sf)), 100)


@query
def od_page(spark, sf):
    return trips.page(fx.od(spark, sf), 50, 2)


@query
def gate_metrics(spark, sf):
    t, st = fx.raw_trips(spark, sf), fx.stations(spark, sf)
    return gates.all_of(
        gates.metric(t, "trips", F.count(F.lit(1))),
        gates.metric(gates.missing(t, ["ending_time"]), "open trips", F.count(F.lit(1))),
        gates.metric(gates.duplicates(t, ["ride_id"]), "repeated rides", F.count(F.lit(1)), "should be 0"),
        gates.metric(gates.orphans(t, "end_sid", st, "sid"), "unknown ends", F.count(F.lit(1)), "should be 0"),
    )


@query
def dense_ids(spark, sf):
    od = fx.od(spark, sf)
    ranks = cuts.numbered(od.select("start_sid").distinct(), "start_rank", "start_sid")
    return od.join(ranks, "start_sid").select("od_id", "start_sid", "end_sid", "start_rank")


@query
def flow_keyword_sum(spark, sf):
    rows = fx.table(spark, sf, "lineitem").join(fx.table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    q = F.col("l_quantity").cast("long")
    hit = text.contains_any(F.col("p_type"), ("LARGE", "PRO"))
    return rows.agg(F.sum(F.when(hit, q)).alias("keyword_sum"), F.sum(F.when(F.col("p_name").rlike("(bolt|rod|^hot)"), q)).alias("pattern_sum"), F.sum(q).alias("total"))


# C: incremental maintenance, star join


@query
def flow_upsert(spark, sf):
    t = fx.valid_trips(spark, sf).select(F.col("start_sid").alias("id"), F.lit(1).cast("long").alias("total_trips"), (F.col("ride_id") % 4).alias("batch"))
    state = None
    for b in range(4):
        part = t.where(F.col("batch") == b).drop("batch")
        state = flows.add_to(part.limit(0), part) if state is None else flows.add_to(state, part)
    return state


@query
def route_first_wins(spark, sf):
    rows = fx.valid_trips(spark, sf).where("start_sid <> end_sid").select(F.concat_ws("-", "start_sid", "end_sid").alias("od_id"), "ride_id", (F.col("ride_id") % 4).alias("batch"))
    state = None
    for b in range(4):
        part = rows.where(F.col("batch") == b).groupBy("od_id").agg(F.min("ride_id").alias("ride_id"), F.min("batch").alias("batch"))
        state = part if state is None else flows.first_wins(state, part)
    return state


@query
def fact_star(spark, sf):
    """Lines and revenue from the supplier's to the customer's nation, without home trade."""
    part = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", F.rint(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("from_nation"))
    c = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("to_nation"))
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    n = fx.table(spark, sf, "nation")
    pairs = part.join(s, "l_suppkey").join(o, "l_orderkey").join(c, "o_custkey").where("from_nation <> to_nation").groupBy("from_nation", "to_nation").agg(F.count(F.lit(1)).alias("lines"), F.sum("cents").alias("cents"))
    a, b = (n.select(F.col("n_nationkey").alias(f"{w}_nation"), F.col("n_name").alias(f"{w}_name")) for w in ("from", "to"))
    return pairs.join(a, "from_nation").join(b, "to_nation").select("from_name", "to_name", "lines", "cents")


# D: geometry


@query
def knn_snap(spark, sf):
    near = spatial.nearest_point(fx.stations(spark, sf), "sid", "geom", fx.vertices(spark, sf), "id", "geom")
    return near.select("sid", F.col("target").alias("vertex"), F.col("d2").cast("long").alias("d2"))


def _centrelines(spark, sf) -> DataFrame:
    """A short slanting line through every vertex."""
    ends = F.array(geo.point(F.col("x") - 500, F.col("y") + 300), geo.point(F.col("x") + 500, F.col("y") - 300))
    return fx.vertices(spark, sf).select(F.col("id").alias("cl_id"), ends.alias("geom_m"))


def _edge_trips(spark, sf) -> DataFrame:
    """Edges with a made-up number of trips."""
    return fx.edges(spark, sf).select("id", ((F.col("id") * 37) % 101 + 1).alias("total_trips"), F.col("geom").alias("geom_m"))


def _assigned(spark, sf) -> DataFrame:
    return flows.attributed(_edge_trips(spark, sf), _centrelines(spark, sf), CAP)


@query
def knn_capped(spark, sf):
    return flows.total(_assigned(spark, sf))


@query
def flow_lwavg(spark, sf):
    return flows.length_weighted(_assigned(spark, sf), _centrelines(spark, sf))


@query
def flow_max(spark, sf):
    return flows.largest(_assigned(spark, sf))


@query
def pip_tag(spark, sf):
    return spatial.tag_within(fx.points(spark, sf).select("id", "geom"), fx.boxes(spark), "id").select("id", "area")


@query
def pip_drop(spark, sf):
    return spatial.outside(fx.points(spark, sf).select("id", "geom"), fx.boxes(spark), "id").select("id")


@query
def bbox_clip(spark, sf):
    return spatial.in_envelope(fx.edges(spark, sf), "geom", -5000, -5000, 8000, 4000).select("id", "source", "target")


@query
def line_within_area(spark, sf):
    """Edges that lie in one area, and those that meet any."""
    e, a = fx.edges(spark, sf).select("id", "geom"), fx.boxes(spark)
    inside = spatial.lines_by_area(e, a, "id").select("id", F.lit("within").alias("how"))
    return inside.unionByName(spatial.lines_by_area(e, a, "id", whole=False).select("id", F.lit("meets").alias("how")))


@query
def utm_project(spark, sf):
    p = fx.lonlat(spark, sf).withColumn("m", geo.to_utm(F.col("geom")))
    back = geo.from_utm(F.col("m"))
    return p.select("id", F.round(F.col("m.x"), 3).alias("x"), F.round(F.col("m.y"), 3).alias("y"), F.round(back["x"] - F.col("geom.x"), 9).alias("dx"), F.round(back["y"] - F.col("geom.y"), 9).alias("dy"))


@query
def edge_length(spark, sf):
    return fx.edges(spark, sf).select("id", F.round(geo.length(F.col("geom")), 6).alias("length"), F.round(geo.interpolate(F.col("geom"))["x"], 6).alias("mid_x"), geo.start_point(F.col("geom"))["x"].alias("start_x"), geo.end_point(F.col("geom"))["y"].alias("end_y"))


# E: graph


@query
def od_combinations(spark, sf):
    return fx.combos(spark, sf)


@query
def sssp_dist(spark, sf):
    sources = fx.snapped(spark, sf).select(F.col("vertex").alias("o"))
    return graph.distances(fx.edges(spark, sf), sources).select("o", "n", F.col("d").cast("long").alias("d"))


def _paths(spark, sf) -> tuple[DataFrame, DataFrame]:
    combos = cuts.cut(fx.combos(spark, sf), "combos")
    return graph.paths(fx.edges(spark, sf), combos), combos


@query
def edge_flows(spark, sf):
    found, combos = _paths(spark, sf)
    return flows.edge_flows(found, combos)


@query
def route_edges(spark, sf):
    found, combos = _paths(spark, sf)
    return combos.join(found, ["source", "target"]).select("od_id", F.size("edge_ids").cast("long").alias("edges"), F.col("cost").cast("long").alias("cost"))


def _short(spark, sf) -> DataFrame:
    return fx.edges(spark, sf).where("cost < 2500")


@query
def components(spark, sf):
    return graph.components(_short(spark, sf), "source", "target")


@query
def largest_component(spark, sf):
    return graph.largest(graph.components(_short(spark, sf), "source", "target"))


@query
def endpoint_cluster(spark, sf):
    v = fx.vertices(spark, sf)
    return graph.cluster(v, "id", "x", "y", 1500.0).join(v, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y"))


# F: animation


def _tl(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trips, routes by od_id, clocked trips); a route is the straight line between two stations."""
    t, st = fx.valid_trips(spark, sf), fx.stations(spark, sf)
    od = fx.od(spark, sf)
    a, b = st.select(F.col("sid").alias("start_sid"), F.col("geom").alias("g1")), st.select(F.col("sid").alias("end_sid"), F.col("geom").alias("g2"))
    rts = od.join(a, "start_sid").join(b, "end_sid").select("od_id", "start_sid", "end_sid", F.array("g1", "g2").alias("geom"))
    rts = cuts.numbered(rts, "route_id", "od_id")
    return t, rts, timelapse.clocked(t, od, rts, CLOCK)


@query
def tl_trips(spark, sf):
    _, _, tl = _tl(spark, sf)
    return tl.select("ride_id", "route_id", F.round(F.col("t0").cast("double"), 3).alias("t0"), F.round(F.col("dur").cast("double"), 3).alias("dur"), _day("day").alias("day"))


@query
def tl_meta(spark, sf):
    t, rts, tl = _tl(spark, sf)
    m = timelapse.meta(t, rts, tl, CLOCK)
    return m.withColumn("period_start", text.iso(F.col("period_start"))).withColumn("period_end", text.iso(F.col("period_end")))


@query
def tl_gates(spark, sf):
    _, rts, tl = _tl(spark, sf)
    return gates.timelapse(tl, rts)


@query
def tl_samples(spark, sf):
    _, _, tl = _tl(spark, sf)
    return timelapse.sampled(tl).select("ride_id", F.col("samp").cast("int").alias("samp"))


@query
def tl_day_window(spark, sf):
    """Written by day, then read back for one day and window, thinned to half the samples."""
    _, rts, tl = _tl(spark, sf)
    path = f"{cuts.folder(spark)}/days-{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    sinks.by_day(timelapse.sampled(tl).select("ride_id", "t0", "dur", "samp", "day"), path)
    return timelapse.windowed(spark, path, "2024-01-10", 0.0, 1000.0, 128).select("ride_id", F.col("samp").cast("int").alias("samp"))


def _degrees(line):
    return F.transform(line, lambda p: geo.point(p["x"] / 1e6 - 74.0, p["y"] / 1e6 + 40.7))


@query
def polyline_roundtrip(spark, sf):
    e = fx.edges(spark, sf).select("id", codec.from_polyline(codec.polyline(_degrees(F.col("geom")))).alias("p"))
    p = e.select("id", F.posexplode("p").alias("seq", "p"))
    return p.select("id", "seq", F.rint(F.col("p.x") * 1e6).cast("long").alias("x"), F.rint(F.col("p.y") * 1e6).cast("long").alias("y"))


@query
def vertex_times(spark, sf):
    e = fx.edges(spark, sf).select("id", F.col("id").cast("double").alias("t0"), codec.polyline(_degrees(F.concat("geom", F.array(geo.point(F.lit(0), F.lit(0)))))).alias("geom"))
    out = timelapse.playback(e).select("id", F.posexplode("times").alias("seq", "t"))
    return out.select("id", "seq", F.round("t", 3).alias("t"))


def _walks(spark, sf) -> DataFrame:
    """walk, line: the points in order of their ids, 64 to a walk."""
    st = fx.points(spark, sf).groupBy(F.floor(F.col("id") / 64).alias("walk")).agg(F.array_sort(F.collect_list(F.struct("id", "geom"))).alias("p"))
    return st.select("walk", F.transform("p", lambda v: v["geom"]).alias("line"))


def _kept(walks: DataFrame, line) -> DataFrame:
    total = lambda axis: F.aggregate("kept", F.lit(0).cast("long"), lambda s, p: s + p[axis].cast("long"))
    rows = walks.select("walk", F.size("line").alias("before"), line.alias("kept"))
    return rows.select("walk", "before", F.size("kept").alias("after"), total("x").alias("sum_x"), total("y").alias("sum_y"))


@query
def line_simplify(spark, sf):
    """Walks over the points, simplified; the sums show which points stay."""
    return _kept(_walks(spark, sf), codec.simplified(F.col("line"), 5000.0))


@query
def line_simplify_safely(spark, sf):
    """The same walks, simplified so that none meets itself anew."""
    return _kept(_walks(spark, sf), codec.simplified(F.col("line"), 5000.0, topology=True))
