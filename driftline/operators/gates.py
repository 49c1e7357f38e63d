"""Data-quality gates: each is a row (gate, value, limit, passed); the hard ones raise."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class GateFailed(ValueError):
    """A hard gate did not hold."""


def metric(df: DataFrame, name: str, value, note: str = "") -> DataFrame:
    """One row: name, value (bigint), note. value is an aggregate column."""
    return df.agg(value.cast("long").alias("value")).select(F.lit(name).alias("name"), "value", F.lit(note).alias("note"))


def all_of(*metrics: DataFrame) -> DataFrame:
    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    return out


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: a primary key has none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key the parent lacks: a foreign key has none. Null keys refer to nothing and pass."""
    p = parent.select(F.col(parent_key).alias("_p")).distinct()
    return df.where(F.col(key).isNotNull()).join(p, F.col(key) == F.col("_p"), "left_anti")


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    some = F.lit(False)
    for c in columns:
        some = some | F.col(c).isNull()
    return df.where(some)


def warn(df: DataFrame, name: str) -> int:
    """Warn of the rows of df, if any; their number."""
    n = df.count()
    if n:
        warnings.warn(f"{name}: {n} rows", stacklevel=2)
    return n


def require(df: DataFrame, name: str) -> None:
    """Raise if df has rows."""
    if df.take(1):
        raise GateFailed(f"{name}: {df.count()} rows")


def at_least(value: int, least: int, name: str) -> None:
    if value < least:
        raise GateFailed(f"{name}: {value} is under {least}")


def below(flows: DataFrame, ceiling: int, column: str = "total_trips") -> bool:
    """Whether the largest flow stays under a ceiling; warns if not."""
    most = flows.agg(F.max(column)).first()[0] or 0
    if most >= ceiling:
        warnings.warn(f"largest flow {most} reaches {ceiling}", stacklevel=2)
    return most < ceiling


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df with its rows counted (``rows``) by whatever action runs over it, without a pass of its own; the observation gives the count afterwards."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def timelapse(tl: DataFrame, rts: DataFrame) -> DataFrame:
    unused = rts.join(tl.select("route_id"), "route_id", "left_anti")
    return all_of(
        metric(tl, "trips", F.count(F.lit(1))),
        metric(unused, "routes_without_trips", F.count(F.lit(1)), "should be 0"),
        metric(tl, "t0_min", F.rint(F.min("t0"))),
        metric(tl, "t0_max", F.rint(F.max("t0")), "should not exceed the clock"),
    )
