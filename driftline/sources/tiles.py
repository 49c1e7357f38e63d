"""Map tiles: which tile of a zoom level a point or line falls into (spherical Mercator, x to the east, y to the south)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_x(lng: Column, zoom: int) -> Column:
    return F.floor((lng + 180.0) / 360.0 * (1 << zoom)).cast("int")


def tile_y(lat: Column, zoom: int) -> Column:
    return F.floor((1 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2 * (1 << zoom)).cast("int")


def by_tile(lines: DataFrame, geom: str, zooms: tuple[int, ...] = (10, 11, 12, 13, 14)) -> DataFrame:
    """lines with zoom, tx, ty: each line once for every tile that its vertices lie in, at each zoom level."""

    def at(zoom: int) -> Column:
        tiles = F.array_distinct(F.transform(geom, lambda p: F.struct(tile_x(p["x"], zoom).alias("tx"), tile_y(p["y"], zoom).alias("ty"))))
        return F.transform(tiles, lambda t: F.struct(F.lit(zoom).alias("zoom"), t["tx"].alias("tx"), t["ty"].alias("ty")))

    return lines.withColumn("t", F.explode(F.concat(*(at(z) for z in zooms)))).select(*lines.columns, "t.*")
