"""Line codecs and simplification that no Column expression covers, as Arrow-batched functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.functions.geo import LINE


def encode(points: list[tuple[float, float]], digits: int = 6) -> str:
    """Polyline text of (x, y) points, y first: zig-zag differences in groups of five bits, 63 added to each."""
    out, last = [], (0, 0)
    for x, y in points:
        now = (int(np.rint(y * 10**digits)), int(np.rint(x * 10**digits)))
        for a, b in zip(now, last, strict=True):
            v = (a - b) << 1 if a >= b else ~((a - b) << 1)
            while v > 31:
                out.append(chr((v & 31 | 32) + 63))
                v >>= 5
            out.append(chr(v + 63))
        last = now
    return "".join(out)


def decode(text: str, digits: int = 6) -> list[tuple[float, float]]:
    """Points (x, y) of a polyline text."""
    numbers, value, shift = [], 0, 0
    for c in text:
        bits = ord(c) - 63
        value |= (bits & 31) << shift
        shift += 5
        if bits < 32:
            numbers.append(~(value >> 1) if value & 1 else value >> 1)
            value = shift = 0
    grid = np.cumsum(np.array(numbers, np.int64).reshape(-1, 2), axis=0) / 10**digits
    return [(x, y) for y, x in grid.tolist()]


def _farthest(p: np.ndarray, i: int, j: int) -> tuple[int, float]:
    """The first of the points between i and j that are farthest from the segment from i to j, and its squared distance."""
    d, q = p[j] - p[i], p[i + 1 : j] - p[i]
    l2 = float(d @ d)
    t = np.clip(q @ d / l2, 0, 1) if l2 else np.zeros(len(q))
    off = q - t[:, None] * d
    dist = (off * off).sum(1)
    k = int(dist.argmax())
    return i + 1 + k, float(dist[k])


def simplify(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas-Peucker; keeps both ends, so at least two points of a line that has them."""
    p = np.array(points, float).reshape(-1, 2)
    keep, todo = np.zeros(len(p), bool), [(0, len(p) - 1)]
    if len(p):
        keep[[0, -1]] = True
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        k, dist = _farthest(p, i, j)
        if dist > tolerance * tolerance:
            keep[k] = True
            todo += [(i, k), (k, j)]
    return [points[k] for k in np.flatnonzero(keep)]


def _side(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sign of the turn from a over b to c."""
    return np.sign((b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0]))


def _inside(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether c, which lies on the line through a and b, lies between them and is neither."""
    boxed = ((np.minimum(a, b) <= c) & (c <= np.maximum(a, b))).all(-1)
    return boxed & (c != a).any(-1) & (c != b).any(-1)


def _meets(a: np.ndarray, b: np.ndarray, s: np.ndarray, e: np.ndarray) -> bool:
    """Whether the segment from a to b has a point with one of the segments (s, e) that is not an end of both."""
    near = ((np.minimum(s, e) <= np.maximum(a, b)) & (np.maximum(s, e) >= np.minimum(a, b))).all(1)
    s, e = s[near], e[near]
    a, b = np.broadcast_to(a, s.shape), np.broadcast_to(b, s.shape)
    ss, se, sa, sb = _side(a, b, s), _side(a, b, e), _side(s, e, a), _side(s, e, b)
    met = (ss * se < 0) & (sa * sb < 0)
    for zero, x, y, z in ((ss, a, b, s), (se, a, b, e), (sa, s, e, a), (sb, s, e, b)):
        met |= (zero == 0) & _inside(x, y, z)
    return bool(met.any())


def simplify_safely(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas-Peucker that keeps topology: a stretch becomes one segment only if that segment neither crosses nor touches the
    rest of the line, as it then is, but at their common ends; else it is split further. So the line never meets itself where
    it did not before. A closed line keeps four points at least, if it has them."""
    p = np.array(points, float).reshape(-1, 2)
    keep, todo = np.ones(len(p), bool), [(0, len(p) - 1, 1)]
    closed = len(p) > 1 and bool((p[0] == p[-1]).all())
    while todo:
        i, j, depth = todo.pop()
        if j - i < 2:
            continue
        k, dist = _farthest(p, i, j)
        if dist <= tolerance * tolerance and (depth > 2 or not closed):
            before, after = p[: i + 1][keep[: i + 1]], p[j:][keep[j:]]
            if not _meets(p[i], p[j], np.concatenate([before[:-1], after[:-1]]), np.concatenate([before[1:], after[1:]])):
                keep[i + 1 : j] = False
                continue
        todo += [(i, k, depth + 1), (k, j, depth + 1)]
    return [points[k] for k in np.flatnonzero(keep)]


def _points(line) -> list[tuple[float, float]]:
    return [(p["x"], p["y"]) for p in line]


def polyline(line: Column, digits: int = 6) -> Column:
    """Text of a line; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else encode(_points(v), digits))

    return F.pandas_udf(run, "string")(line)


def from_polyline(text: Column, digits: int = 6) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else [{"x": x, "y": y} for x, y in decode(v, digits)])

    return F.pandas_udf(run, LINE)(text)


def simplified(line: Column, tolerance: float, topology: bool = False) -> Column:
    """The line by ``simplify``, or with topology by ``simplify_safely``; null stays null."""
    thin = simplify_safely if topology else simplify

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else [{"x": x, "y": y} for x, y in thin(_points(v), tolerance)])

    return F.pandas_udf(run, LINE)(line)
