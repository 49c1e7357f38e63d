"""Planar geometry as Column expressions.

A point is struct<x: double, y: double>, a line array<point>, a polygon array<ring> with rings as arrays of points, the
first the outer one, closed or not. The coordinate system is part of a column's name, as ``geom`` (degrees)
and ``geom_m`` (metres).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def segments(line: Column) -> Column:
    """Array of struct<a: point, b: point> of successive vertices; empty below two."""
    return F.zip_with(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def distance2(p: Column, q: Column) -> Column:
    dx, dy = p["x"] - q["x"], p["y"] - q["y"]
    return dx * dx + dy * dy


def length(line: Column) -> Column:
    return F.aggregate(segments(line), F.lit(0.0), lambda s, e: s + F.sqrt(distance2(e["a"], e["b"])))


def start_point(line: Column) -> Column:
    return F.element_at(line, 1)


def end_point(line: Column) -> Column:
    return F.element_at(line, -1)


def n_points(line: Column) -> Column:
    return F.size(line)


def is_line(line: Column, least: float = 0.0) -> Column:
    """Two distinct vertices at least, and no shorter than ``least``."""
    return F.coalesce((F.size(F.array_distinct(line)) >= 2) & (length(line) >= least), F.lit(False))


def is_point(p: Column) -> Column:
    return F.coalesce(p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]), F.lit(False))


def drop_repeats(line: Column) -> Column:
    """Without vertices equal to the one before."""
    return F.filter(line, lambda p, i: (i == 0) | (p != F.get(line, i - 1)))


def rounded(line: Column, digits: int) -> Column:
    return F.transform(line, lambda p: F.struct(F.round(p["x"], digits).alias("x"), F.round(p["y"], digits).alias("y")))


def interpolate(line: Column, share: float = 0.5) -> Column:
    """Point at a share of the length; the first vertex of a line without length."""
    step = lambda e: F.sqrt(distance2(e["a"], e["b"]))
    walk = lambda total: F.aggregate(
        segments(line),
        F.struct(F.lit(0.0).alias("done"), F.lit(None).cast(POINT).alias("at")),
        lambda s, e: F.struct(
            (s["done"] + step(e)).alias("done"),
            F.when(s["at"].isNotNull() | (s["done"] + step(e) < total), s["at"])
            .otherwise(along(e["a"], e["b"], F.when(distance2(e["a"], e["b"]) > 0, (total - s["done"]) / step(e)).otherwise(0.0)))
            .alias("at"),
        ),
    )
    # over a list of one, so that the length is added up once and not anew at every vertex
    return F.coalesce(F.get(F.transform(F.array(length(line) * share), walk), F.lit(0))["at"], end_point(line))


def along(a: Column, b: Column, t: Column) -> Column:
    return F.struct((a["x"] + (b["x"] - a["x"]) * t).alias("x"), (a["y"] + (b["y"] - a["y"]) * t).alias("y"))


def segment_distance2(p: Column, a: Column, b: Column) -> Column:
    """Squared distance of a point from a segment."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / l2))).otherwise(0.0)
    ex, ey = p["x"] - (a["x"] + t * dx), p["y"] - (a["y"] + t * dy)
    return ex * ex + ey * ey


def line_distance2(p: Column, line: Column) -> Column:
    return F.array_min(F.transform(segments(line), lambda e: segment_distance2(p, e["a"], e["b"])))


def _ring_crossings(p: Column, ring: Column) -> Column:
    """Number of edges of a closed ring that a ray to the right of p crosses."""
    nxt = lambda i: F.get(ring, (i + 1) % F.size(ring))
    crossed = F.transform(
        ring,
        lambda a, i: F.when(
            ((a["y"] > p["y"]) != (nxt(i)["y"] > p["y"])) & (p["x"] < (nxt(i)["x"] - a["x"]) * (p["y"] - a["y"]) / (nxt(i)["y"] - a["y"]) + a["x"]), 1
        ).otherwise(0),
    )
    return F.aggregate(crossed, F.lit(0), lambda s, c: s + c)


def _odd(p: Column, polygon: Column) -> Column:
    """Even-odd rule over all rings, so holes are out; a point on a ring may fall to either side."""
    return F.aggregate(F.transform(polygon, lambda r: _ring_crossings(p, r)), F.lit(0), lambda s, c: s + c) % 2 == 1


def within(p: Column, polygon: Column) -> Column:
    """Whether a point lies inside a polygon, not in a hole and not on a ring."""
    return _odd(p, polygon) & ~F.exists(polygon, lambda r: F.exists(_edges(r), lambda e: (_orient(e["a"], e["b"], p) == 0) & _on(e["a"], e["b"], p)))


def _orient(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _on(a: Column, b: Column, p: Column) -> Column:
    return (p["x"] >= F.least(a["x"], b["x"])) & (p["x"] <= F.greatest(a["x"], b["x"])) & (p["y"] >= F.least(a["y"], b["y"])) & (p["y"] <= F.greatest(a["y"], b["y"]))


def segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    o1, o2, o3, o4 = _orient(a, b, c), _orient(a, b, d), _orient(c, d, a), _orient(c, d, b)
    touch = ((o1 == 0) & _on(a, b, c)) | ((o2 == 0) & _on(a, b, d)) | ((o3 == 0) & _on(c, d, a)) | ((o4 == 0) & _on(c, d, b))
    return ((o1 != o2) & (o3 != o4)) | touch


def _edges(ring: Column) -> Column:
    return F.transform(ring, lambda a, i: F.struct(a.alias("a"), F.get(ring, (i + 1) % F.size(ring)).alias("b")))


def _crosses(line: Column, polygon: Column) -> Column:
    return F.exists(segments(line), lambda s: F.exists(polygon, lambda r: F.exists(_edges(r), lambda e: segments_meet(s["a"], s["b"], e["a"], e["b"]))))


def line_within(line: Column, polygon: Column) -> Column:
    """All vertices inside and no edge of the polygon met."""
    return F.forall(line, lambda p: within(p, polygon)) & ~_crosses(line, polygon)


def line_intersects(line: Column, polygon: Column) -> Column:
    return F.exists(line, lambda p: _odd(p, polygon)) | _crosses(line, polygon)


def bounds(line: Column) -> Column:
    """struct<x0, y0, x1, y1>."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def overlaps(box: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """Whether a bounds() struct and an envelope share a point."""
    return (box["x0"] <= x1) & (box["x1"] >= x0) & (box["y0"] <= y1) & (box["y1"] >= y0)


#: WGS 84: semi-major axis and flattening; scale of UTM on its central meridian; false easting. Fixed values.
AXIS, FLATTENING, UTM_SCALE, FALSE_EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0


def krueger() -> tuple[float, float, tuple[float, float, float, float], tuple[float, float, float, float]]:
    """Rectifying radius, first eccentricity and the forward and backward series of the transverse Mercator projection
    to fourth order in the third flattening (Karney 2011, equations 12, 35 and 36)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    return radius, math.sqrt(FLATTENING * (2 - FLATTENING)), alpha, beta


def to_utm(p: Column, zone: int = 18) -> Column:
    """Degrees (x: longitude, y: latitude) to metres of a northern UTM zone."""
    radius, e, alpha, _ = krueger()
    lat, lam = F.radians(p["y"]), F.radians(p["x"] - F.lit(zone * 6.0 - 183.0))
    s = F.sin(lat)
    t = F.sinh(F.atanh(s) - F.atanh(s * e) * e)
    xi, eta = F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    north, east = xi, eta
    for j, a in enumerate(alpha, 1):
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
    return F.struct((east * (UTM_SCALE * radius) + FALSE_EAST).alias("x"), (north * (UTM_SCALE * radius)).alias("y"))


def from_utm(p: Column, zone: int = 18) -> Column:
    """Metres of a northern UTM zone to degrees."""
    radius, e, _, beta = krueger()
    xi, eta = p["y"] / (UTM_SCALE * radius), (p["x"] - FALSE_EAST) / (UTM_SCALE * radius)
    north, east = xi, eta
    for j, b in enumerate(beta, 1):
        north = north - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b
        east = east - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b
    lam = F.atan2(F.sinh(east), F.cos(north))
    conformal = F.asin(F.sin(north) / F.cosh(east))
    # three fixed-point steps from the conformal to the geographic latitude reach rounding error
    lat = conformal
    for _ in range(4):
        lat = F.asin(F.tanh(F.atanh(F.sin(conformal)) + F.atanh(F.sin(lat) * e) * e))
    return F.struct((F.degrees(lam) + F.lit(zone * 6.0 - 183.0)).alias("x"), F.degrees(lat).alias("y"))


def line_to_utm(line: Column, zone: int = 18) -> Column:
    return F.transform(line, lambda p: to_utm(p, zone))


def line_from_utm(line: Column, zone: int = 18) -> Column:
    return F.transform(line, lambda p: from_utm(p, zone))
