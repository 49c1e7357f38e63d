"""Spatial joins by grid cells and exact refinement. No join here is a product of both sides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions import geo
from driftline.operators.cuts import cut


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def cells_of_box(box: Column, size: float, margin: int = 0) -> Column:
    """Array of struct<cx, cy> of all cells that a bounds() struct touches, and ``margin`` cells around."""
    xs = F.sequence(cell(box["x0"], size) - margin, cell(box["x1"], size) + margin)
    ys = F.sequence(cell(box["y0"], size) - margin, cell(box["y1"], size) + margin)
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def _distinct_segments(lines: DataFrame, key: str, geom: str) -> DataFrame:
    """ax, ay, bx, by, target: every distinct segment of all lines with the smallest key that has it; a line of one vertex is a point."""
    whole = F.when(F.size(geom) >= 2, geo.segments(F.col(geom))).otherwise(F.array(F.struct(geo.start_point(F.col(geom)).alias("a"), geo.start_point(F.col(geom)).alias("b"))))
    segs = lines.select(F.col(key).alias("target"), F.explode(whole).alias("s")).where(geo.is_point(F.col("s.a")) & geo.is_point(F.col("s.b")))
    return segs.groupBy(F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by")).agg(F.min("target").alias("target"))


def _segment_cells(segs: DataFrame, size: float, x0: float, x1: float, y0: float, y1: float) -> DataFrame:
    """segs with cx, cy: every cell that the segment passes, up to two beyond the bounds.

    The cells follow the segment, so that a long one does not fill its bounding box: a column of cells gets the part of
    the segment that lies in it. Cells count as wider by a thousandth on each side, so that rounding loses none."""
    slack = size / 1000
    span = lambda lo, hi: F.explode(F.when(lo <= hi, F.sequence(lo, hi, F.lit(1).cast("long"))))
    first = F.greatest(cell(F.least("ax", "bx") - slack, size), cell(F.lit(x0), size) - 2)
    last = F.least(cell(F.greatest("ax", "bx") + slack, size), cell(F.lit(x1), size) + 2)
    columns = segs.select("*", span(first, last).alias("cx"))
    dx = F.col("bx") - F.col("ax")
    share = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - F.col("ax")) / dx))
    at = lambda x, flat: F.col("ay") + F.when(dx != 0, share(x)).otherwise(flat) * (F.col("by") - F.col("ay"))
    ya, yb = at(F.col("cx") * F.lit(size) - slack, 0.0), at((F.col("cx") + 1) * F.lit(size) + slack, 1.0)
    low = F.greatest(cell(F.least(ya, yb) - slack, size), cell(F.lit(y0), size) - 2)
    high = F.least(cell(F.greatest(ya, yb) + slack, size), cell(F.lit(y1), size) + 2)
    return columns.select("*", span(low, high).alias("cy"))


def nearest_within(points: DataFrame, key: str, geom: str, lines: DataFrame, line_key: str, line_geom: str, cap: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, target, d: the nearest line closer than cap to each point that has one; ties go to the smallest line key.
    Columns of points named in ``keep`` follow.

    Growing cells, searched once a distinct position: the first are as narrow as points and segments lie close, so that
    the work does not grow with the number of lines within the cap. A segment lies in the cells that it passes. The
    nearest segment of a point's own cell is the nearest of all if the cell's bounds are no closer; else it bounds how
    far the cells around are searched. Points whose cell no segment passes go on to the next cells, eight times as
    wide; the last are as wide as the cap, and all cells within it are searched.
    """
    at = points.select(F.col(key).alias("_k"), F.struct(F.lit(True).alias("_"), *keep).alias("_kept"), F.col(geom).alias("_p"))
    # unfolded from a list of one, so that the point is computed once and not anew for each use
    at = at.select("_k", "_kept", F.inline(F.array("_p")).alias("px", "py")).where(geo.is_point(F.struct(F.col("px").alias("x"), F.col("py").alias("y"))))
    at = cut(at, "points")
    segs = cut(_distinct_segments(lines, line_key, line_geom), "segments")
    todo = at.select("px", "py").distinct()
    quarters = lambda c: F.percentile_approx(c, [0.25, 0.75])
    x0, x1, y0, y1, xs, ys, spots = todo.agg(F.min("px"), F.max("px"), F.min("py"), F.max("py"), quarters("px"), quarters("py"), F.count(F.lit(1))).first()
    extent, count = segs.agg(F.avg(F.abs(F.col("bx") - F.col("ax")) + F.abs(F.col("by") - F.col("ay"))), F.count(F.lit(1))).first()
    names = [F.col(f"_kept.{c}").alias(c) for c in keep]
    if not spots or not count:
        return at.select(F.col("_k").alias(key), F.lit(None).cast(segs.schema["target"].dataType).alias("target"), F.lit(None).cast("double").alias("d"), *names).limit(0)
    middle = max(xs[1] - xs[0], ys[1] - ys[0]) or max(x1 - x0, y1 - y0)
    # no narrower than lets a segment have a bounded number of cells on the average
    size = max(4 * middle / math.sqrt(min(spots, count)), extent / 32, cap / 4096)
    p2 = geo.segment_distance2(F.struct(F.col("px").alias("x"), F.col("py").alias("y")), F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))

    def searched(rows: DataFrame, reach: Column) -> DataFrame:
        """px, py, d2, target: the nearest segment of the cells as far as reach around each row's point."""
        mine = rows.select("px", "py", reach.alias("r"))
        for v, c in (("px", "cx"), ("py", "cy")):
            mine = mine.select("*", F.explode(F.sequence(cell(F.col(v) - F.col("r"), size), cell(F.col(v) + F.col("r"), size))).alias(c))
        # merged: a point's lines meet in one task, and crowded cells are split
        pairs = mine.drop("r").hint("merge").join(_segment_cells(segs, size, x0, x1, y0, y1), ["cx", "cy"]).withColumn("d2", p2)
        return pairs.groupBy("px", "py").agg(F.min(F.struct("d2", "target")).alias("m")).select("px", "py", "m.d2", "m.target")

    done = None
    while True:
        last = size * 2 >= cap
        if last:
            size = cap
            near = searched(todo, F.lit(float(cap)))
        else:
            found = cut(searched(todo, F.lit(0.0)), "nearest")
            inside = lambda v: F.least(v - F.floor(v / size) * size, (F.floor(v / size) + 1) * size - v)
            border = F.greatest(F.lit(0.0), F.least(inside(F.col("px")), inside(F.col("py"))))
            sure = F.col("d2") <= border * border
            near = found.where(sure).unionByName(searched(found.where(~sure), F.least(F.sqrt("d2"), F.lit(float(cap)))))
        near = near.where(F.col("d2") < F.lit(float(cap) * cap))
        done = near if done is None else done.unionByName(near)
        if last:
            break
        todo = cut(todo.join(found, ["px", "py"], "left_anti"), "open")
        if not todo.take(1):
            break
        size *= 8
    return at.join(done, ["px", "py"]).select(F.col("_k").alias(key), "target", F.sqrt("d2").alias("d"), *names)


def nearest_point(points: DataFrame, key: str, geom: str, targets: DataFrame, target_key: str, target_geom: str) -> DataFrame:
    """key, target, d2: the nearest target point of each point, however far; ties go to the smallest target key.

    Rings of growing cells: a round joins the points still open with the targets of the 3 x 3 cells around them and
    settles those whose best target is no farther than a cell is wide; the next round's cells are four times as wide.
    """
    p = points.select(F.col(key).alias("_k"), F.col(geom)["x"].alias("px"), F.col(geom)["y"].alias("py"))
    t = targets.select(F.col(target_key).alias("target"), F.col(target_geom)["x"].alias("tx"), F.col(target_geom)["y"].alias("ty")).where("tx is not null and ty is not null")
    span = t.agg(F.min("tx"), F.max("tx"), F.min("ty"), F.max("ty"), F.count(F.lit(1))).first()
    if not span[4]:
        return p.select(F.col("_k").alias(key), F.lit(None).cast("long").alias("target"), F.lit(None).cast("double").alias("d2"))
    reach = p.agg(F.min("px"), F.max("px"), F.min("py"), F.max("py")).first()
    if reach[0] is None:
        return p.select(F.col("_k").alias(key), F.lit(None).cast("long").alias("target"), F.lit(None).cast("double").alias("d2")).limit(0)
    width = max(max(span[1], reach[1]) - min(span[0], reach[0]), max(span[3], reach[3]) - min(span[2], reach[2]), 1e-9)
    size = max(width / max(1.0, math.sqrt(span[4])) * 2, 1e-9)
    done, todo = None, p
    while True:
        last = size >= width  # 3 x 3 such cells around any point hold every target
        around = t.select("*", cell(F.col("tx"), size).alias("tcx"), cell(F.col("ty"), size).alias("tcy"))
        steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
        mine = todo.withColumn("s", F.explode(steps)).select("_k", "px", "py", (cell(F.col("px"), size) + F.col("s.i")).alias("tcx"), (cell(F.col("py"), size) + F.col("s.j")).alias("tcy"))
        d2 = (F.col("px") - F.col("tx")) * (F.col("px") - F.col("tx")) + (F.col("py") - F.col("ty")) * (F.col("py") - F.col("ty"))
        best = mine.join(around, ["tcx", "tcy"]).withColumn("d2", d2).groupBy("_k").agg(F.min(F.struct("d2", "target")).alias("m"))
        best = best.select("_k", "m.target", "m.d2")
        found = best if last else best.where(F.col("d2") <= F.lit(size * size))
        if last:
            return (found if done is None else done.unionByName(found)).select(F.col("_k").alias(key), "target", "d2")
        found = cut(found, "nearest")
        done = found if done is None else done.unionByName(found)
        todo = cut(todo.join(found.select("_k"), "_k", "left_anti"), "open")
        if not todo.take(1):
            return done.select(F.col("_k").alias(key), "target", "d2")
        size *= 4


def nearest_others(points: DataFrame, key: str, geom: str, k: int, places: bool = False) -> DataFrame:
    """key, target, d2: the k nearest other points of each point (all others if there are fewer); ties go to the smallest key.
    With ``places``, the coordinates of both follow: px, py, tx, ty.

    Growing cells as in ``nearest_point``, searched once a distinct position. Of the points of one position only the
    k + 1 smallest keys can be among the k nearest of any point, so a crowded place costs no more than others. Where the
    3 x 3 cells hold enough points, the farthest of the nearest bounds how far the cells around are searched, so that
    only positions with too few points there go on to wider cells.
    """
    p = points.select(F.col(key).alias("_k"), F.col(geom)["x"].alias("px"), F.col(geom)["y"].alias("py")).where("px is not null and py is not null")
    p = cut(p, "points")
    low = p.withColumn("r", F.row_number().over(Window.partitionBy("px", "py").orderBy("_k"))).where(F.col("r") <= k + 1)
    t = cut(low.select(F.col("_k").alias("target"), F.col("px").alias("tx"), F.col("py").alias("ty")), "targets")
    todo = t.select(F.col("tx").alias("px"), F.col("ty").alias("py")).distinct()
    quarters = lambda c: F.percentile_approx(c, [0.25, 0.75])
    x0, x1, y0, y1, xs, ys, spots = todo.agg(F.min("px"), F.max("px"), F.min("py"), F.max("py"), quarters("px"), quarters("py"), F.count(F.lit(1))).first()
    more = ["px", "py", "tx", "ty"] if places else []
    if not spots:
        return p.select(F.col("_k").alias(key), F.col("_k").alias("target"), F.lit(None).cast("double").alias("d2"), *(F.lit(None).cast("double").alias(c) for c in more)).limit(0)
    need = min(k + 1, t.count())  # a point is among the nearest of its own position
    width = max(x1 - x0, y1 - y0, 1e-9)
    middle = max(xs[1] - xs[0], ys[1] - ys[0])  # far points do not widen the first cells
    size = max((2 * middle or width) / math.sqrt(spots) * 2, width * 1e-9)
    at = Window.partitionBy("px", "py")

    def searched(rows: DataFrame, low, high) -> DataFrame:
        """px, py, target, tx, ty, d2, r: the nearest of the cells from low to high; with how many there are, the farthest, and the largest key of those in the place."""
        around = t.select("*", cell(F.col("tx"), size).alias("tcx"), cell(F.col("ty"), size).alias("tcy"))
        mine = rows
        for v, c in (("px", "tcx"), ("py", "tcy")):
            mine = mine.select("*", F.explode(F.sequence(low(F.col(v)), high(F.col(v)), F.lit(1).cast("long"))).alias(c))
        d2 = (F.col("px") - F.col("tx")) * (F.col("px") - F.col("tx")) + (F.col("py") - F.col("ty")) * (F.col("py") - F.col("ty"))
        pairs = mine.select("px", "py", "tcx", "tcy").join(around, ["tcx", "tcy"]).select("px", "py", "target", "tx", "ty", d2.alias("d2"))
        near = pairs.withColumn("r", F.row_number().over(at.orderBy("d2", "target"))).where(F.col("r") <= need)
        return near.withColumns({"n": F.count(F.lit(1)).over(at), "far": F.max("d2").over(at), "top": F.max(F.when(F.col("d2") == 0, F.col("target"))).over(at)})

    done = None
    while True:
        last = size >= width  # 3 x 3 such cells around any point hold every target
        near = found = cut(searched(todo, lambda v: cell(v, size) - 1, lambda v: cell(v, size) + 1), "nearest")
        if not last:
            found = found.where(F.col("n") == need)
            sure = F.col("far") <= F.lit(size * size * (1 - 1e-6))
            wide = found.where(~sure).where("r = 1").select("px", "py", (F.sqrt("far") + F.lit(size * 1e-6)).alias("_r"))
            near = found.where(sure).unionByName(searched(wide, lambda v: cell(v - F.col("_r"), size), lambda v: cell(v + F.col("_r"), size)))
        done = near if done is None else done.unionByName(near)
        if last:
            break
        todo = cut(todo.join(found.where("r = 1"), ["px", "py"], "left_anti"), "open")
        if not todo.take(1):
            break
        size *= 4
    # the nearest without the point itself, which is among them unless smaller keys fill the place
    others = p.join(done, ["px", "py"]).where((F.col("target") != F.col("_k")) & ((F.col("r") <= k) | (F.col("_k") <= F.col("top"))))
    return others.select(F.col("_k").alias(key), "target", "d2", *more)


def _area_size(areas: DataFrame) -> float:
    """A cell as wide as the mean extent of an area's box."""
    box = geo.bounds(F.flatten("geom"))
    got = areas.select(F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"]).alias("w")).agg(F.avg("w")).first()[0]
    return got or 1.0


def _area_cells(areas: DataFrame, name: str, size: float) -> DataFrame:
    return areas.select(F.col(name).alias("area"), F.col("geom").alias("area_geom"), F.explode(cells_of_box(geo.bounds(F.flatten("geom")), size)).alias("c")).select("area", "area_geom", "c.cx", "c.cy")


def tag_within(points: DataFrame, areas: DataFrame, key: str, geom: str = "geom", name: str = "name") -> DataFrame:
    """points inside an area, with its name as ``area``: the smallest name where areas overlap."""
    size = _area_size(areas)
    p = points.select(F.col(key).alias("_k"), F.col(geom).alias("_p"), cell(F.col(geom)["x"], size).alias("cx"), cell(F.col(geom)["y"], size).alias("cy"))
    hit = p.join(_area_cells(areas, name, size), ["cx", "cy"]).where(geo.within(F.col("_p"), F.col("area_geom")))
    best = hit.groupBy("_k").agg(F.min("area").alias("area"))
    return points.join(best, points[key] == best["_k"]).drop("_k")


def outside(points: DataFrame, areas: DataFrame, key: str, geom: str = "geom", name: str = "name") -> DataFrame:
    """points in no area."""
    inside = tag_within(points.select(key, geom), areas, key, geom, name).select(key)
    return points.join(inside, key, "left_anti")


def lines_by_area(lines: DataFrame, areas: DataFrame, key: str, geom: str = "geom", name: str = "name", whole: bool = True) -> DataFrame:
    """Lines that lie within one area (whole) or that meet any area (not whole); each line once."""
    size = _area_size(areas)
    boxed = lines.select(F.col(key).alias("_k"), F.col(geom).alias("_l"), F.explode(cells_of_box(geo.bounds(F.col(geom)), size)).alias("c")).select("_k", "_l", "c.cx", "c.cy")
    pairs = boxed.join(_area_cells(areas, name, size), ["cx", "cy"]).select("_k", "_l", "area", "area_geom").dropDuplicates(["_k", "area"])
    test = geo.line_within if whole else geo.line_intersects
    hit = pairs.where(test(F.col("_l"), F.col("area_geom"))).select(F.col("_k").alias(key)).distinct()
    return lines.join(hit, key, "left_semi")


def in_envelope(lines: DataFrame, geom: str, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Lines whose bounding box overlaps the envelope."""
    return lines.where(geo.overlaps(geo.bounds(F.col(geom)), x0, y0, x1, y1))


def close_pairs(points: DataFrame, key: str, x: str, y: str, eps: float) -> DataFrame:
    """Links a, b (a > b) between points at most eps apart, enough to connect what is connected through such pairs.

    Points of one small cell (eps / sqrt(2) wide) are all within eps of each other, so each is linked to the cell's
    smallest key; between neighbouring cells pairs are compared. A crowded place thus costs one link a point, and the
    pairs between cells are compared point by point only for distinct positions.
    """
    size = eps / math.sqrt(2) * (1 - 1e-9) if eps > 0 else 1.0
    p = points.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    same = p.groupBy("x", "y").agg(F.min("k").alias("low"))
    copies = p.join(same, ["x", "y"]).where("k <> low").select(F.col("k").alias("a"), F.col("low").alias("b"))
    if eps <= 0:
        return copies
    spots = same.select("low", "x", "y", cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy"))
    heads = spots.groupBy("cx", "cy").agg(F.min("low").alias("head"))
    inner = spots.join(heads, ["cx", "cy"]).where("low <> head").select(F.col("low").alias("a"), F.col("head").alias("b"))
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)))
    moved = spots.withColumn("s", F.explode(steps)).select(F.col("low").alias("o"), F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    d2 = (F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy"))
    across = spots.join(moved, ["cx", "cy"]).where(d2 <= F.lit(eps * eps)).select(F.greatest("low", "o").alias("a"), F.least("low", "o").alias("b"))
    return copies.union(inner).union(across)
