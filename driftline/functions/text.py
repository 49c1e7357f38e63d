"""String and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.config import Settings


def station_id(raw: Column, codes: tuple[tuple[str, str], ...] = Settings.station_codes) -> Column:
    """Trimmed id; one with a known prefix becomes the prefix's code and its final digits. Null stays null."""
    s = F.trim(raw)
    out = s
    for pattern, code in reversed(codes):
        out = F.when(s.rlike(pattern), F.concat(F.lit(code), F.regexp_extract(s, r"(\d+)$", 1))).otherwise(out)
    return out


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether the upper-cased text has one of the parts."""
    up = F.upper(text)
    found = F.lit(False)
    for p in parts:
        found = found | up.contains(p)
    return found


def number(text: Column) -> Column:
    """Double, or null where the text is no number."""
    return text.try_cast("double")


def whole(x: Column) -> Column:
    """Bigint by rounding half to even."""
    return F.rint(x).cast("long")


def timestamp(text: Column) -> Column:
    """Timestamp without zone, or null."""
    return text.try_cast("timestamp_ntz")


def seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, with fractions."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
