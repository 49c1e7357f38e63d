"""Expressions of the animation clock and of playback along a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.config import Settings
from driftline.functions.geo import segments
from driftline.functions.text import seconds


def on_clock(start: Column, ts: Column, span_s: Column, clock_s: int) -> Column:
    """Place of a timestamp on a clock of clock_s seconds that spans the period."""
    return seconds(start, ts) / span_s * clock_s


def clock_length(start: Column, end: Column, span_s: Column, s: Settings) -> Column:
    return F.greatest(F.lit(s.min_dur), seconds(start, end) / span_s * s.clock_s)


def clock_rounded(t_min: Column, start: Column, end: Column, span_s: Column, s: Settings) -> tuple[Column, Column]:
    """(t0, dur) with both ends on a clock of two decimals, the length taken between the rounded ends."""
    a, b = (F.round(on_clock(t_min, t, span_s, s.clock_s), 2) for t in (start, end))
    return a, F.round(F.greatest(F.lit(s.min_dur), b - a), 2)


def chords(line: Column) -> Column:
    """Running length from the first vertex, in degrees of latitude (longitudes shrunk by the cosine at the later vertex)."""
    step = F.transform(
        segments(line),
        lambda e: F.sqrt(F.pow((e["b"]["x"] - e["a"]["x"]) * F.cos(F.radians(e["b"]["y"])), 2) + F.pow(e["b"]["y"] - e["a"]["y"], 2)),
    )
    return F.aggregate(step, F.array(F.lit(0.0)), lambda s, d: F.concat(s, F.array(F.element_at(s, -1) + d)))


def eased(share: Column, ease: float) -> Column:
    """Share of the time at a share of the way: slow in the first and last ``ease``."""
    return (
        F.when(share < ease, F.sqrt(share / ease) * ease).when(share > 1 - ease, 1 - F.sqrt((1 - share) / ease) * ease).otherwise(share)
    )


def vertex_times(line: Column, t0: Column, s: Settings) -> Column:
    """Array of the times at which a ride along the line passes its vertices."""
    run = chords(line)
    total = F.element_at(run, -1)
    dur = F.greatest(F.lit(s.min_playback_s), total * s.metres_per_degree / s.speed_mps)
    return F.transform(run, lambda d: t0 + dur * eased(d / F.when(total > 0, total).otherwise(1.0), s.ease))
