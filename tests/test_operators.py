import json
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import geo
from driftline.operators import clean, flows, gates, graph, network, spatial, timelapse, trips
from driftline.operators import stations as stations_
from driftline.plans import fixtures, pipeline
from driftline.sources import readers, sinks

T0 = datetime(2023, 6, 10, 8)


def test_duration_bounds(spark):
    ends = [(T0, T0), (T0, T0 + timedelta(hours=24)), (T0, T0 + timedelta(hours=24, seconds=1)), (T0, T0 - timedelta(1)), (T0, None)]
    df = spark.createDataFrame(ends, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(clean.valid_duration(F.col("a"), F.col("b"))).collect()] == [False, True, False, False, False]


def test_mode_breaks_ties(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "w"), ("a", "x"), ("a", "w"), ("b", "z")], "k string, v string")
    assert {tuple(r) for r in stations_.mode(df, "k", ["v"]).collect()} == {("a", "w", 2), ("b", "z", 1)}


def brute_distances(edges, source):
    dist, todo = {source: 0}, [source]
    while todo:
        v = todo.pop()
        for _, s, t, c, r in edges:
            for a, b, w in ((s, t, c), (t, s, r)):
                if a == v and w >= 0 and dist[v] + w < dist.get(b, 1e18):
                    dist[b] = dist[v] + w
                    todo.append(b)
    return dist


@pytest.fixture(scope="module")
def small_graph(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(12), rnd.randrange(12), rnd.randrange(1, 9), rnd.choice([-1, rnd.randrange(1, 9)])) for i in range(22)]
    return rows, spark.createDataFrame(rows, "id long, source long, target long, cost long, reverse_cost long")


def test_both_searches_agree_with_brute_force(spark, small_graph):
    rows, df = small_graph
    want = {(o, n, float(d)) for o in (0, 3, 99) for n, d in brute_distances(rows, o).items()}
    sources = spark.createDataFrame([(0,), (3,), (99,)], "o long")
    assert {tuple(r) for r in graph.distances(df, sources).collect()} == want
    assert {tuple(r) for r in graph.relaxed(graph.arcs(df), sources).collect()} == want


def test_paths_are_paths(spark, small_graph):
    rows, df = small_graph
    pairs = spark.createDataFrame([(a, b) for a in (0, 3) for b in range(14) if a != b], "source long, target long")
    by_id = {r[0]: r for r in rows}
    got = {(r.source, r.target): r for r in graph.paths(df, pairs).collect()}
    far = {(r.source, r.target): r for r in graph.paths(df, pairs, Settings(max_broadcast_edges=3)).collect()}
    want = {(o, n): d for o in (0, 3) for n, d in brute_distances(rows, o).items() if n != o and n < 14}
    assert {k: r.cost for k, r in got.items()} == want == {k: r.cost for k, r in far.items()}
    for k, r in got.items():
        assert far[k].edge_ids == r.edge_ids
        total = 0
        assert len(r.vertices) == len(r.edge_ids) + 1
        for e, a, b in zip(r.edge_ids, r.vertices, r.vertices[1:], strict=False):
            _, s, t, c, back = by_id[e]
            options = [w for x, y, w in ((s, t, c), (t, s, back)) if (x, y) == (a, b) and w >= 0]
            total += min(options)
        assert total == r.cost and (r.vertices[0], r.vertices[-1]) == k
    combos = spark.createDataFrame([(1, 0, 5, 7), (2, 0, 5, 1), (3, 3, 99, 4)], "od_id long, source long, target long, trip_count long")
    found = graph.paths(df, combos)
    total = flows.edge_flows(found, combos).agg(F.sum("total_trips")).first()[0]
    assert total == 8 * len(got[0, 5].edge_ids)  # two pairs share their vertices; the unreachable one has no row
    steps = graph.path_rows(found, combos).collect()
    assert sum(r.edge == -1 for r in steps) == 2


def test_paths_over_free_arcs(spark):
    edges = spark.createDataFrame([(1, 1, 2, 0, 0), (2, 2, 3, 0, 0), (3, 3, 1, 0, 0), (4, 3, 4, 1, 1)], "id long, source long, target long, cost long, reverse_cost long")
    r = graph.paths(edges, spark.createDataFrame([(1, 4), (1, 1)], "source long, target long")).orderBy("target").collect()
    assert [(x.edge_ids, x.cost) for x in r] == [([], 0.0), ([3, 4], 1.0)] or r[1].vertices[0] == 1 and r[1].vertices[-1] == 4


def test_both_path_forms_take_the_same_free_arcs(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(14), rnd.randrange(14), rnd.choice([0, 0, 1, 2]), rnd.choice([-1, 0, 1])) for i in range(26)]
    edges = spark.createDataFrame(rows, "id long, source long, target long, cost long, reverse_cost long")
    pairs = spark.createDataFrame([(a, b) for a in (0, 3) for b in range(14) if a != b], "source long, target long")
    near, far = ({(r.source, r.target): (r.edge_ids, r.vertices, r.cost) for r in graph.paths(edges, pairs, s).collect()} for s in (Settings(), Settings(max_broadcast_edges=3)))
    assert near == far
    assert {k: c for k, (_, _, c) in near.items()} == {(o, n): d for o in (0, 3) for n, d in brute_distances(rows, o).items() if n != o}


def test_hot_sources_are_searched_in_blocks(spark, small_graph, monkeypatch):
    _, df = small_graph
    pairs = spark.createDataFrame([(a, b) for a in (0, 3, 5) for b in range(14) if a != b and (a != 5 or b < 2)], "source long, target long")
    whole = {tuple(map(str, r)) for r in graph.paths(df, pairs).collect()}
    monkeypatch.setattr(graph, "TARGETS", 3)
    assert {tuple(map(str, r)) for r in graph.paths(df, pairs).collect()} == whole


def test_relaxing_stops_at_the_targets(spark):
    chain = spark.createDataFrame([(i, i, i + 1, 1, 1) for i in range(30)], "id long, source long, target long, cost long, reverse_cost long")
    asked = spark.createDataFrame([(0, 2), (0, 77), (5, 3)], "source long, target long")  # 77 has no arc into it, so nobody waits for it
    reached = graph._relaxed(graph.arcs(chain), asked.selectExpr("source as o"), asked).collect()
    assert max(r.n for r in reached if r.o == 0) <= 3 and min(r.n for r in reached if r.o == 5) >= 2
    got = {(r.source, r.target): r.cost for r in graph.relaxed_paths(graph.arcs(chain), asked).collect()}
    assert got == {(0, 2): 2.0, (5, 3): 2.0}


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (4, 7), (3, 1)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 4, 9: 9}
    assert sorted(r[0] for r in graph.largest(graph.components(links)).collect()) == [1, 2, 3]


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.component for r in graph.components(links).collect()} == {0}


def test_nearest_point_and_cluster(spark):
    rnd = random.Random(5)
    p = [(i, rnd.random() * 1000, rnd.random() * 1000) for i in range(60)] + [(60, 9e5, 9e5)]
    t = [(i, rnd.random() * 100, rnd.random() * 100) for i in range(30)] + [(30, 7.0, 7.0), (31, 7.0, 7.0)]
    df = lambda rows: spark.createDataFrame(rows, "id long, x double, y double").withColumn("geom", geo.point(F.col("x"), F.col("y")))
    want = {i: min(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in t)[1] for i, x, y in p}
    assert {r.id: r.target for r in spatial.nearest_point(df(p), "id", "geom", df(t), "id", "geom").collect()} == want
    assert spatial.nearest_point(df(p), "id", "geom", df(t).limit(0), "id", "geom").where("target is null").count() == 61
    links = {i: i for i, _, _ in t}

    def root(i):
        while links[i] != i:
            i = links[i]
        return i

    for i, x, y in t:
        for j, u, v in t:
            if (x - u) ** 2 + (y - v) ** 2 <= 144:
                a, b = root(i), root(j)
                links[max(a, b)] = min(a, b)
    assert {r.id: r.cluster for r in graph.cluster(df(t), "id", "x", "y", 12.0).collect()} == {i: root(i) for i, _, _ in t}


def brute_nearest(rows, k):
    return {(i, j, (x - u) ** 2 + (y - v) ** 2) for i, x, y in rows for j, u, v in sorted((r for r in rows if r[0] != i), key=lambda r: ((x - r[1]) ** 2 + (y - r[2]) ** 2, r[0]))[:k]}


def test_nearest_others(spark):
    rnd = random.Random(8)
    p = [(i, float(rnd.randrange(300)), float(rnd.randrange(300))) for i in range(150)] + [(150, 9e5, 9e5)] + [(200 + i, 7.0, 7.0) for i in range(40)]
    for rows in (p, p[:3], p[:1], []):
        df = spark.createDataFrame(rows, "id long, x double, y double").withColumn("geom", geo.point(F.col("x"), F.col("y")))
        assert {tuple(r) for r in spatial.nearest_others(df, "id", "geom", 4).collect()} == brute_nearest(rows, 4)


def test_far_neighbours_need_no_wider_cells(spark, monkeypatch):
    rnd, rounds, plain = random.Random(0), [], spatial.cut
    p = [(i, float(round(rnd.gauss(0, 1000))), float(round(rnd.gauss(0, 1000)))) for i in range(400)]
    monkeypatch.setattr(spatial, "cut", lambda df, name: rounds.append(name) or plain(df, name))
    df = spark.createDataFrame(p, "id long, x double, y double").withColumn("geom", geo.point(F.col("x"), F.col("y")))
    assert {tuple(r) for r in spatial.nearest_others(df, "id", "geom", 4).collect()} == brute_nearest(p, 4)
    assert rounds.count("nearest") == 2


def test_graph_of_all_vectors(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 0.1), rnd.gauss(0, 0.1)], i % 10) for i in range(620)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    at = [(r.id, r.x, r.y) for r in fixtures.points(spark, str(tmp_path)).collect()]
    assert len(at) == 620
    want = sorted((i, j, round(d2**0.5)) for i, j, d2 in brute_nearest([r for r in at if r[0] >= 100], 4))
    got = fixtures.edges(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.source, r.target, r.cost) for r in got] == want and [r.id for r in got] == list(range(1, 2081))


def test_nearest_line_within_cap(spark):
    lines = spark.createDataFrame([(1, [(0.0, 0.0), (100.0, 0.0)]), (2, [(0.0, 50.0), (0.0, 20.0)]), (3, [(5.0, 5.0)])], f"cl_id long, geom {geo.LINE}")
    pts = spark.createDataFrame([(1, (50.0, 10.0)), (2, (1.0, 30.0)), (3, (500.0, 500.0)), (4, (5.0, 6.0)), (5, (50.0, 30.0))], f"id long, p {geo.POINT}")
    got = {r.id: (r.target, round(r.d, 6)) for r in spatial.nearest_within(pts, "id", "p", lines, "cl_id", "geom", 30.0).collect()}
    assert got == {1: (1, 10.0), 2: (2, 1.0), 4: (3, 1.0)}  # 30 away is not closer than 30


def crowd():
    """Places and lines in a square, with ties, copies, far and long ones, and those without length or exactly the cap away."""
    rnd = random.Random(4)
    spot = lambda: (float(rnd.randrange(1000)), float(rnd.randrange(1000)))
    lines = [(i, [(x, y), (x + rnd.randrange(-30, 30), y + rnd.randrange(-30, 30))]) for i in range(10, 1500) for x, y in [spot()]]
    lines += [(5000 - i, g) for i, g in lines[:300]] + [(1, [(-3000.0, 40.0), (900.0, 1100.0), (900.0, -3000.0)]), (2, [(7.0, 7.0)]), (3, [(2500.0, 0.0), (2500.0, 9.0)])]
    places = [(i, spot()) for i in range(600)] + [(600 + i, (7.0, 7.0)) for i in range(40)] + [(700, (2100.0, 3.0)), (701, (2900.0, 3.0)), (702, (2101.0, 3.0)), (703, (1e6, 1e6)), (704, None)]
    return places, lines


def brute_lines(places, lines, cap):
    def d2(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return (p[0] - (a[0] + t * dx)) ** 2 + (p[1] - (a[1] + t * dy)) ** 2

    best = {i: min((d2(p, a, b), k) for k, g in lines for a, b in zip(g, g[1:] or g, strict=False)) for i, p in places if p}
    return {i: k for i, (d, k) in best.items() if d < cap * cap}


@pytest.fixture
def met(spark, monkeypatch):
    """How many pairs of a place and a segment have been measured."""
    seen, plain = spark.sparkContext.accumulator(0), geo.segment_distance2
    noted = F.udf(lambda d: seen.add(1) or d, "double")
    monkeypatch.setattr(geo, "segment_distance2", lambda p, a, b: noted(plain(p, a, b)))
    return seen


def test_nearest_line_among_many(spark, met):
    places, lines = crowd()
    pts, cls = spark.createDataFrame(places, f"id long, p {geo.POINT}"), spark.createDataFrame(lines, f"cl_id long, geom {geo.LINE}")
    got = spatial.nearest_within(pts, "id", "p", cls, "cl_id", "geom", 400.0)
    assert {r.id: r.target for r in got.collect()} == brute_lines(places, lines, 400.0)
    assert met.value < 100 * len(places)  # not all lines within the cap
    for some in (pts.limit(0), pts):
        assert spatial.nearest_within(some, "id", "p", cls.limit(0), "cl_id", "geom", 400.0).collect() == []


def test_long_lines_lie_in_the_cells_that_they_pass(spark):
    rnd = random.Random(6)
    spot = lambda: (rnd.random() * 1000, rnd.random() * 1000)
    places, lines = [(i, spot()) for i in range(200)], [(i, [spot(), spot()]) for i in range(200)]
    lines += [(200 + i, [(x, 0.0), (x, 1000.0)]) for i in range(10) for x in [rnd.random() * 1000]]
    pts, cls = spark.createDataFrame(places, f"id long, p {geo.POINT}"), spark.createDataFrame(lines, f"cl_id long, geom {geo.LINE}")
    passed = sum(1 + sum(abs(a // 50 - b // 50) for a, b in zip(*g, strict=True)) for _, g in lines)
    cells = spatial._segment_cells(spatial._distinct_segments(cls, "cl_id", "geom"), 50.0, 0.0, 1000.0, 0.0, 1000.0)
    assert passed <= cells.count() < 1.1 * passed
    got = spatial.nearest_within(pts, "id", "p", cls, "cl_id", "geom", 400.0, keep=("p",)).collect()
    assert {r.id: r.target for r in got} == brute_lines(places, lines, 400.0) and {r.id: tuple(r.p) for r in got} == dict(places)


def attributed_crowd(spark):
    """Flows across the places, centrelines, and the assignment by brute force: id, trips, length, cl_id."""
    places, lines = crowd()
    trips = {i: (i * 37) % 101 + 1 for i, _ in places}
    rows = [(i, trips[i], [(p[0] - 3.0, p[1] + 4.0), (p[0] + 3.0, p[1] - 4.0)]) for i, p in places if p]
    by_place = brute_lines(places, lines, 400.0)
    net, cls = spark.createDataFrame(rows, f"id long, total_trips long, geom_m {geo.LINE}"), spark.createDataFrame(lines, f"cl_id long, geom_m {geo.LINE}")
    return net, cls, flows.attributed(net, cls, 400.0), [(i, n, 10.0, by_place[i]) for i, n, _ in rows if i in by_place]


def test_dropped_share_among_many(spark, met):
    net, _, assigned, want = attributed_crowd(spark)
    got = flows.dropped_percent(net, assigned).first()
    assert got.after == sum(n for _, n, _, _ in want) < got.before and met.value < 100 * net.count()


def test_length_weighting_among_many(spark, met):
    net, cls, assigned, want = attributed_crowd(spark)
    sums, plain = {}, {}
    for _, n, length, k in want:
        sums[k], plain[k] = sums.get(k, 0.0) + n * length, plain.get(k, 0) + n
    lens = {r.cl_id: r.len for r in cls.select("cl_id", geo.length(F.col("geom_m")).alias("len")).collect()}
    assert {tuple(r) for r in flows.length_weighted(assigned, cls).collect()} == {(k, round(v / lens[k]) if lens[k] > 0 else plain[k]) for k, v in sums.items()}
    assert met.value < 100 * net.count()


def test_largest_flow_among_many(spark, met):
    net, _, assigned, want = attributed_crowd(spark)
    most = {}
    for _, n, _, k in want:
        most[k] = max(n, most.get(k, 0))
    assert {tuple(r) for r in flows.largest(assigned).collect()} == set(most.items())
    assert met.value < 100 * net.count()


def test_half_even_weighting(spark):
    a = spark.createDataFrame([(1, 7, 5, [(0.0, 0.0), (1.0, 0.0)]), (2, 8, 1, [(0.0, 0.0), (1.0, 0.0)])], f"id long, cl_id long, total_trips long, geom_m {geo.LINE}")
    c = spark.createDataFrame([(7, [(0.0, 0.0), (2.0, 0.0)]), (8, [(1.0, 1.0), (1.0, 1.0)])], f"cl_id long, geom_m {geo.LINE}")
    assert {tuple(r) for r in flows.length_weighted(a, c).collect()} == {(7, 2), (8, 1)}


def test_upserts(spark):
    old, new = spark.createDataFrame([(1, 2), (2, 3)], "id long, total_trips long"), spark.createDataFrame([(2, 5), (3, 1)], "id long, total_trips long")
    assert sorted(map(tuple, flows.add_to(old, new).collect())) == [(1, 2), (2, 8), (3, 1)]
    assert sorted(map(tuple, flows.first_wins(old, new, "id").collect())) == [(1, 2), (2, 3), (3, 1)]


def test_gates(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 9)], "k long, v long")
    assert gates.duplicates(df, ["k"]).count() == 1
    assert gates.orphans(df, "v", df, "k").count() == 2
    with pytest.warns(UserWarning):
        assert gates.warn(gates.missing(df, ["v"]), "nulls") == 1
    with pytest.raises(gates.GateFailed):
        gates.require(gates.missing(df, ["v"]), "nulls")
    with pytest.raises(gates.GateFailed):
        gates.at_least(3, 5, "size")
    with pytest.warns(UserWarning):
        assert not gates.below(df, 9, "v")


def raw_row(i, a, b, start, minutes):
    names = {"1": "First & Main", "2": "Second", "3": "Third"}
    at = {"1": (40.7001, -74.0001), "2": (40.7101, -74.0001), "3": (40.7101, -73.9901)}
    t = start + timedelta(minutes=minutes)
    return (f"r{i}", "bike", str(start), str(t), names[a], a, names[b], b, *map(str, (*at[a], *at[b])), "member")


@pytest.fixture(scope="module")
def city(spark, tmp_path_factory):
    rows = [raw_row(i, a, b, T0 + timedelta(hours=i), 10 + i) for i, (a, b) in enumerate([("1", "2"), ("1", "2"), ("2", "3"), ("1", "3"), ("3", "3"), ("1", "3")])]
    rows += [rows[0], raw_row(9, "1", "2", T0, 0), raw_row(10, "1", "2", T0, 60 * 25)]
    path = tmp_path_factory.mktemp("raw")
    head = " Ride_ID ," + ",".join(readers.TRIP_COLUMNS[1:])
    (path / "a-tripdata.csv").write_text("\n".join([head, *(",".join(r) for r in rows[:5])]))
    (path / "._a-tripdata.csv").write_text("junk")
    with zipfile.ZipFile(path / "b.zip", "w") as z:
        z.writestr("202306-b.csv", "\n".join([head, *(",".join(r) for r in rows[5:])]))
        z.writestr("__MACOSX/202306-b.csv", "junk")
    corners = [(-74.0, 40.70), (-74.0, 40.71), (-73.99, 40.71)]
    geojson = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"full_street_name": n, "rw_type": t, "nonped": m}, "geometry": {"type": "MultiLineString", "coordinates": [[list(a), list(b)]]}}
        for n, t, m, a, b in [("UP ST", "1", None, corners[0], corners[1]), ("ACROSS BRIDGE", "1", "", corners[1], corners[2]), ("HIGHWAY", "2", None, corners[0], corners[2]), ("PATH", "3", "V", corners[0], corners[2])]
    ]}
    (path / "streets.geojson").write_text(json.dumps(geojson))
    return path


def test_city_from_files_to_animation(spark, city, tmp_path):
    raw = readers.csv_trips(spark, str(city)).unionByName(readers.zipped_csv(spark, str(city), ("202306",)))
    assert raw.count() == 9
    streets = readers.geojson(spark, str(city / "streets.geojson"), {"street_name": "full_street_name", "rw_type": "rw_type", "nonped": "nonped", "absent": "no_such"}, "line")
    streets = streets.withColumn("id", F.monotonically_increasing_id() + 1).drop("absent").cache()
    area = spark.createDataFrame([("town", [[(-74.1, 40.6), (-73.9, 40.6), (-73.9, 40.8), (-74.1, 40.8)]])], f"name string, geom array<{geo.LINE}>")
    s = Settings(min_component=3)
    t = pipeline.run(raw, area, streets, s)
    assert t.stations.count() == 3 and t.trips.count() == 6
    assert {(r.start_sid, r.end_sid): r.trip_count for r in t.od_pairs.collect()} == {(1, 2): 2, (1, 3): 2, (2, 3): 1}
    assert {r.street_name: r.total_trips for r in t.edge_flows.collect()} == {"UP ST": 4, "ACROSS BRIDGE": 3}
    assert sorted(r.edge_count for r in t.routes.collect()) == [1, 1, 2]
    assert flows.keyword_trips(t.edge_flows, "street_name", s.keywords).first().trips == 3
    assert {r.total_trips for r in t.variants["max"].collect()} == {4, 3}
    out = t.animation
    assert out.count() == 5 and t.meta.first().n_trips == 5
    sinks.by_day(out, str(tmp_path / "days"))
    back = timelapse.windowed(spark, str(tmp_path / "days"), "2023-06-10", 0, 1e9)
    assert back.count() == 5
    play = timelapse.packed(timelapse.playback(back), "t0").first()
    assert play.length == 5 and len(play.timestamps) * 2 == len(play.positions) and play.start_indices[-1] == len(play.timestamps)
    with pytest.raises(gates.GateFailed):
        pipeline.run(raw, area, streets, Settings())


def test_network_filters(spark):
    lines = spark.createDataFrame([(1, "2", None), (2, "3", "V"), (3, "3", None), (4, None, "V"), (5, "x", "D")], "id long, rw_type string, nonped string")
    assert sorted(r.id for r in network.rideable(lines).collect()) == [3, 4, 5]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, [(0.123456, 1.0), (2.0, 3.0)])], f"id long, geom {geo.LINE}")
    doc = json.loads(sinks.geojson_document(df, order="id").first().value)
    assert doc["features"][0]["geometry"] == {"type": "LineString", "coordinates": [[0.123456, 1.0], [2.0, 3.0]]} and doc["features"][0]["properties"] == {"id": 1}
    sinks.geojson_lines(df, str(tmp_path / "g"))
    assert json.loads(spark.read.text(str(tmp_path / "g")).first().value)["type"] == "Feature"
    assert sinks.once(df, str(tmp_path / "p")) and not sinks.once(df, str(tmp_path / "p"))
    assert sinks.written_bytes(spark, str(tmp_path / "p")) > 0
    routes = df.select(F.lit(0).alias("route_id"), "geom")
    tr = spark.createDataFrame([(0, 2.0, 0.5), (0, 1.0, 0.1)], "route_id int, t0 double, dur double")
    got = json.loads(sinks.compact_routes(routes, tr, spark.createDataFrame([(180,)], "anim_duration_s int")).first().value)
    assert got == {"anim_duration_s": 180, "routes": [[[0.12346, 1.0], [2.0, 3.0]]], "trips": [[0.0, 1.0, 0.1], [0.0, 2.0, 0.5]]}


def test_geometry_texts(spark):
    import struct

    wkb = struct.pack("<BIIdddd", 1, 2, 2, 0, 1, 2, 3).hex()
    df = spark.createDataFrame([(wkb, "POLYGON((0 0, 1 0, 1 1),(0.1 0.1, 0.2 0.1, 0.2 0.2))"), ("zz", None)], "w string, t string")
    r = df.select(readers.wkb_line(F.col("w")).alias("l"), readers.wkt_polygon(F.col("t")).alias("p")).collect()
    assert [tuple(p) for p in r[0].l] == [(0.0, 1.0), (2.0, 3.0)] and r[1].l is None
    assert len(r[0].p) == 2 and tuple(r[0].p[1][2]) == (0.2, 0.2)


def test_pages_and_tops(spark):
    pairs = trips.numbered(spark.createDataFrame([(1, 2, 5), (1, 3, 9), (2, 1, 9)], "start_sid long, end_sid long, trip_count long"))
    assert [r.od_id for r in trips.top(pairs, 2).collect()] == [2, 3] and trips.top(pairs, 0).count() == 3
    assert [r.od_id for r in trips.page(pairs, 2, 1).collect()] == [3]


def test_settings_from_env():
    assert Settings.from_env({"N_OD_PAIRS": "7", "SNAP_CAP_M": ""}) == Settings(n_od_pairs=7)


def test_names_and_area_gate(spark):
    edges = spark.createDataFrame([(1, 10, 11, "Old BRIDGE"), (2, 11, 12, None), (3, 20, 21, "Way")], "id long, source long, target long, street_name string")
    assert {tuple(r) for r in network.named(edges, "street_name", ("(BRIDGE|BRG)", "TUNNEL")).collect()} == {("(BRIDGE|BRG)", 1), ("TUNNEL", 0)}
    snapped = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "c")], "sid long, vertex long, borough string")
    assert sorted(r[0] for r in network.areas_gate(edges, snapped, ("a", "b", "d")).collect()) == ["b", "d"]


def test_tiles(spark):
    from driftline.sources import tiles

    df = spark.createDataFrame([(1, [(-74.0, 40.7), (-73.9, 40.7), (-74.0, 40.7)])], f"id long, geom {geo.LINE}")
    got = {(r.zoom, r.tx, r.ty) for r in tiles.by_tile(df, "geom", (0, 12)).collect()}
    assert got == {(0, 0, 0), (12, 1206, 1540), (12, 1207, 1540)}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import zipfile

    from driftline.sources import readers

    one = "ride_id,started_at,start_lat,member_casual\na,2023-06-01 00:00:00,40.5,member\n"
    two = " Member_Casual ,extra,RIDE_ID\ncasual,x,b\n"
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "one.csv").write_text(one)
    (tmp_path / "in" / "deep" / "two.csv").write_text("﻿" + two)
    (tmp_path / "in" / "._three.csv").write_text("q\nz\n")
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.writestr("one.csv", one)
        z.writestr("two.csv", two)
    want = [("a", "2023-06-01 00:00:00", "40.5", "member", "one.csv"), ("b", None, None, "casual", "two.csv")]
    columns = ["ride_id", "started_at", "start_lat", "member_casual", "source_file"]
    for got in (readers.csv_trips(spark, str(tmp_path / "in")), readers.zipped_csv(spark, str(tmp_path))):
        assert sorted((tuple(r) for r in got.select(*columns).collect()), key=lambda r: r[0]) == want
    with pytest.raises(FileNotFoundError):
        readers.csv_trips(spark, str(tmp_path / "in"), "*.txt")


def test_batches_of_routes_are_the_routes(spark):
    from driftline.plans.pipeline import _found

    edges = spark.createDataFrame([(1, 1, 2, 1.0, 1.0), (2, 2, 3, 1.0, 1.0), (3, 3, 4, 1.0, -1.0)], "id long, source long, target long, cost double, reverse_cost double")
    combos = spark.createDataFrame([(1, 1, 3, 5), (2, 1, 4, 2), (9, 4, 1, 1), (10, 2, 3, 1), (11, 2, 3, 4)], "od_id long, source long, target long, trip_count long")
    rows = lambda s: sorted((r.source, r.target, tuple(r.edge_ids)) for r in _found(edges, combos, s).collect())
    assert rows(Settings(route_batch=2)) == rows(Settings()) == [(1, 3, (1, 2)), (1, 4, (1, 2, 3)), (2, 3, (2,))]


def test_run_parameters():
    from driftline.config import Settings

    s = Settings.from_env({"ROUTE_BATCH_SIZE": "7", "MAX_TRIPS": "9", "FLOW_TABLE": "max", "SKIP_TIMELAPSE": "1"})
    assert (s.route_batch, s.max_trips, s.flow_table, s.skip_timelapse) == (7, 9, "max", True)
    assert not Settings.from_env({"SKIP_TIMELAPSE": "0"}).skip_timelapse


def test_metres_and_multipolygons(spark):
    from driftline.sources import readers

    rows = spark.createDataFrame([("SRID=4326;MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (0.2 0.1, 0.3 0.1, 0.3 0.2, 0.2 0.1)), ((5 5, 6 5, 6 6, 5 5)))",), ("POLYGON((0 0,1 0,1 1,0 0))",), ("POINT (1 1)",), (None,)], "t string")
    got = [r.a for r in rows.select(readers.wkt_polygons(rows["t"]).alias("a")).collect()]
    assert [[len(r) for p in (a or []) for r in p] for a in got] == [[4, 4, 4], [4], [], []]
    assert got[2] is None and got[3] is None and (got[0][1][0][0].x, got[0][1][0][1].x) == (5.0, 6.0)
