import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions import codec, geo, text, timing

micro = st.integers(-180_000_000, 180_000_000)


@settings(deadline=None)
@given(st.lists(st.tuples(micro, micro), max_size=20))
def test_polyline_round_trip(grid):
    points = [(x / 1e6, y / 1e6) for x, y in grid]
    back = codec.decode(codec.encode(points))
    assert [(round(x * 1e6), round(y * 1e6)) for x, y in back] == grid


def test_polyline_known_text():
    assert codec.encode([(-120.2, 38.5), (-120.95, 40.7), (-126.453, 43.252)], 5) == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=2, max_size=25), st.floats(0.1, 20))
def test_simplify_keeps_ends_and_tolerance(points, tol):
    kept = codec.simplify(points, tol)
    assert kept[0] == points[0] and kept[-1] == points[-1]

    def off(p, a, b):
        l2 = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
        t = max(0, min(1, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / l2)) if l2 else 0
        return math.hypot(p[0] - a[0] - t * (b[0] - a[0]), p[1] - a[1] - t * (b[1] - a[1]))

    assert all(min(off(p, a, b) for a, b in zip(kept, kept[1:], strict=False)) <= tol + 1e-9 for p in points)


def meeting(a, b, c, d):
    """Whether two segments on whole numbers have a point that is not an end of both."""
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    on = lambda p, q, r: side(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1]) and r not in (p, q)
    return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0 or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)


def meetings(line):
    s = list(zip(line, line[1:], strict=False))
    return sum(meeting(*s[i], *s[j]) for i in range(len(s)) for j in range(i))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=16), st.floats(0.1, 20), st.booleans())
def test_safe_simplify_makes_no_new_meetings(points, tol, close):
    points = points + points[:1] if close else points
    kept = codec.simplify_safely(points, tol)
    rest = iter(points)
    assert kept[0] == points[0] and kept[-1] == points[-1] and all(p in rest for p in kept)  # in order
    if not meetings(points):
        assert not meetings(kept)
    if points[0] == points[-1]:
        assert len(kept) >= min(4, len(points))


def test_safe_simplify_keeps_what_plain_one_crosses():
    hook = [(0, 0), (10, 3), (20, 0), (20, -10), (10, 1), (0, -10)]  # the tip of the hook reaches under the bend
    assert not meetings(hook) and meetings(codec.simplify(hook, 3.5)) and not meetings(codec.simplify_safely(hook, 3.5))
    assert codec.simplify_safely([], 1) == [] and codec.simplify_safely([(1, 1)], 1) == [(1, 1)]
    assert codec.simplify_safely([(0, 0), (5, 0.1), (10, 0)], 1) == [(0, 0), (10, 0)]


def one(spark, **cols):
    return spark.range(1).select(*(c.alias(n) for n, c in cols.items())).first()


def line(*xy):
    return F.array(*(geo.point(F.lit(x), F.lit(y)) for x, y in xy))


def test_station_ids(spark):
    raw = ["SYS016", "JC115", "HB201", "Lab - NYC 7", "6425.04", None, " JC ", "my Lab - NYC 3"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in raw], "s string").select(text.station_id(F.col("s"))).collect()]
    assert got == ["9000016", "8000115", "7000201", "60007", "6425.04", None, "8000", "my Lab - NYC 3"]


def test_numbers_and_times(spark):
    r = one(spark, a=text.number(F.lit("x")), b=text.number(F.lit("1.5")), c=text.whole(F.lit(2.5)), d=text.whole(F.lit(3.5)), e=text.timestamp(F.lit("no")), f=text.seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 00:00:01.5").cast("timestamp_ntz")))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (None, 1.5, 2, 4, None, 1.5)


def test_lines(spark):
    zig, flat, dot = line((0, 0), (0, 0), (3, 4)), line((0, 0), (0, 0)), line((1, 1))
    r = one(spark, n=geo.length(zig), m=geo.interpolate(zig), f=geo.length(flat), v=geo.is_line(flat), w=geo.is_line(zig, 0.1), d=geo.is_line(dot), k=F.size(geo.drop_repeats(zig)), e=geo.interpolate(flat))
    assert (r.n, tuple(r.m), r.f, r.v, r.w, r.d, r.k, tuple(r.e)) == (5.0, (1.5, 2.0), 0.0, False, True, False, 2, (0.0, 0.0))


def test_within_and_intersects(spark):
    hole = F.array(line((0, 0), (10, 0), (10, 10), (0, 10)), line((4, 4), (6, 4), (6, 6), (4, 6)))
    ring = F.array(line((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)))  # closed
    at = lambda x, y: geo.point(F.lit(x), F.lit(y))
    r = one(
        spark, a=geo.within(at(5, 5), hole), b=geo.within(at(2, 2), hole), c=geo.within(at(11, 2), hole), r=geo.within(at(5, 5), ring),
        d=geo.line_within(line((1, 1), (2, 2)), hole), e=geo.line_within(line((1, 1), (12, 2)), hole), f=geo.line_intersects(line((-1, 5), (12, 5)), hole),
        g=geo.line_intersects(line((-1, -1), (-2, 5)), hole), h=geo.line_within(line((3, 5), (7, 5)), hole),
    )
    assert tuple(r) == (False, True, False, True, True, False, True, False, False)


def test_points_on_a_ring_are_not_within(spark):
    hole = F.array(line((0, 0), (10, 0), (10, 10), (0, 10)), line((4, 4), (6, 4), (6, 6), (4, 6)))
    slanted = F.array(line((0, 0), (8, 4), (0, 8), (0, 0)))
    on = [(0, 5), (5, 0), (10, 5), (5, 10), (0, 0), (10, 0), (10, 10), (0, 10), (4, 5), (6, 5), (5, 4), (5, 6), (4, 4)]
    near = [(0.001, 5), (5, 0.001), (9.999, 5), (5, 9.999), (3.999, 5), (6.001, 4)]
    ins = lambda places, area: [geo.within(geo.point(F.lit(x), F.lit(y)), area) for x, y in places]
    r = one(spark, on=F.array(*ins(on, hole)), near=F.array(*ins(near, hole)), edge=F.array(*ins([(4, 2), (4, 6), (0, 3), (8, 4)], slanted)), inner=F.array(*ins([(4, 2.001), (1, 4)], slanted)))
    assert not any(r.on) and all(r.near) and not any(r.edge) and all(r.inner)


def test_projection(spark):
    # Central meridian at the equator, and a round trip
    r = one(spark, a=geo.to_utm(geo.point(F.lit(-75.0), F.lit(0.0))), b=geo.from_utm(geo.to_utm(geo.point(F.lit(-73.9), F.lit(40.7)))), c=geo.to_utm(geo.point(F.lit(-73.9), F.lit(40.7))))
    assert (round(r.a.x, 6), round(r.a.y, 6)) == (500000.0, 0.0)
    assert abs(r.b.x + 73.9) < 1e-9 and abs(r.b.y - 40.7) < 1e-9
    assert 592000 < r.c.x < 594000 and 4505000 < r.c.y < 4508000


def test_vertex_times(spark):
    s = Settings()
    r = one(spark, t=timing.vertex_times(line((0, 0), (0.0, 0.01), (0.0, 0.02)), F.lit(10.0), s), z=timing.vertex_times(line((1, 1), (1, 1)), F.lit(5.0), s))
    dur = 0.02 * 111320 / 3.5
    assert abs(r.t[1] - (10 + dur / 2)) < 1e-6 and abs(r.t[2] - (10 + dur)) < 1e-6 and r.z == [5.0, 5.0]
