"""The whole way from raw trips to animation rows, each stage a table that later ones read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import geo
from driftline.operators import clean, flows, gates, graph, network, timelapse, trips
from driftline.operators import stations as stations_
from driftline.operators.cuts import cut


@dataclass
class Tables:
    stations: DataFrame
    trips: DataFrame
    od_pairs: DataFrame
    edges: DataFrame
    vertices: DataFrame
    combinations: DataFrame
    routes: DataFrame
    edge_flows: DataFrame
    variants: dict[str, DataFrame]
    exported_flows: DataFrame
    compact_trips: DataFrame
    animation: DataFrame | None
    meta: DataFrame | None


def _found(edges: DataFrame, combos: DataFrame, s: Settings) -> DataFrame:
    """Paths of all pairs, settled; in batches of od_id if ``route_batch`` is given. A pair of vertices is searched once."""
    asked = combos.groupBy("source", "target").agg(F.min("od_id").alias("od_id"))
    if not s.route_batch:
        return cut(graph.paths(edges, asked, s), "paths")
    asked, out, start = cut(asked, "asked"), None, 0
    last = asked.agg(F.max("od_id")).first()[0] or 0
    while start <= last:
        part = cut(graph.paths(edges, asked.where(F.col("od_id").between(start, start + s.route_batch - 1)), s), "paths")
        out = part if out is None else out.unionByName(part)
        start += s.route_batch
    return out


def run(raw: DataFrame, areas: DataFrame, streets: DataFrame, s: Settings = Settings(), gate: bool = True) -> Tables:
    """raw: see readers.TRIP_COLUMNS; areas: name, geom; streets: id, street_name, rw_type, nonped, geom (degrees).

    Every distinct pair is routed once and weighted by its trips; trips are never unfolded over edges. With ``route_batch`` pairs are
    routed in batches of od_id, each settled before the next; ``flow_table`` names the flows that are exported (those above zero), ``max_trips``
    bounds the trips of the compact export (the first by time), ``skip_timelapse`` leaves out the animation.
    """
    valid = cut(clean.valid(clean.typed(raw), s), "trips")
    st = cut(stations_.tagged(stations_.stations(valid, s), areas), "stations")
    joined = cut(trips.between_stations(valid, st), "joined")
    pairs = cut(trips.top(trips.numbered(trips.od_pairs(joined)), s.n_od_pairs), "pairs")
    edges, vertices = network.network(streets, s)
    edges, vertices = cut(edges, "edges"), cut(vertices, "vertices")
    snapped = cut(network.snap(st, vertices), "snapped")
    if gate:
        gates.warn(stations_.invalid(st), "stations without a place")
        gates.warn(gates.missing(snapped, ["vertex"]), "stations without a vertex")
        gates.warn(gates.missing(edges, ["source", "target"]), "edges without a vertex")
        inside = graph.largest(graph.components(edges, "source", "target"))
        gates.at_least(inside.count(), s.min_component, "largest component")
    combos = cut(trips.combinations(pairs, snapped), "combos")
    found = _found(edges, combos, s)
    routes = cut(flows.routes(found, combos, edges), "routes")
    on_edges = cut(flows.with_attributes(flows.edge_flows(found, combos), edges, ["street_name", "rw_type", "geom", "geom_m"]), "flows")
    lines = streets.select(F.col("id").alias("cl_id"), "street_name", "geom").withColumn("geom_m", geo.line_to_utm(F.col("geom")))
    assigned = cut(flows.attributed(on_edges, lines, s.snap_cap_m), "assigned")
    variants = {"sum": flows.total(assigned), "length_weighted": flows.length_weighted(assigned, lines), "max": flows.largest(assigned)}
    exported = flows.positive(variants[s.flow_table])
    compact = timelapse.first_trips(joined, s.max_trips)
    if s.skip_timelapse:
        return Tables(st, joined, pairs, edges, vertices, combos, routes, on_edges, variants, exported, compact, None, None)
    rts = cut(timelapse.routes(routes, s), "tl_routes")
    tl = cut(timelapse.clocked(joined, pairs, rts, s), "tl_trips")
    return Tables(st, joined, pairs, edges, vertices, combos, routes, on_edges, variants, exported, compact, timelapse.export(tl, rts, s), timelapse.meta(joined, rts, tl, s))
