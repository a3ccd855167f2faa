"""Dates and ages as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(x: Column) -> Column:
    """Timestamp of an ISO text (offset, Z or UTC) or of one of three plain
    forms; anything else gives null."""
    t = F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"), F.try_to_timestamp(F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")))
    forms = [F.when(t.rlike(p), F.try_to_timestamp(t, F.lit(f))) for p, f in ((r"^\d{2}\.\d{2}\.\d{4}$", "dd.MM.yyyy"), (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"))]
    return F.coalesce(iso, *forms)


def iso_instant(x: Column) -> Column:
    """Timestamp of a text that begins with year and month; else null."""
    return F.when(x.rlike(r"^[\s\p{Z}]*\d{4}-"), instant(x))


def age_days(ts: Column, as_of: str) -> Column:
    """Whole days between an instant and ``as_of``, never below 0; null without an instant."""
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(ts)
    return F.when(ts.isNotNull(), F.greatest(F.lit(0), F.floor(seconds / 86400)).cast("long"))


def bucket(days: Column, steps: list[tuple[int, str]], beyond: str, unknown: str = "UNKNOWN") -> Column:
    """Name of the first step that the days don't exceed."""
    out = F.lit(beyond)
    for most, name in reversed(steps):
        out = F.when(days <= most, F.lit(name)).otherwise(out)
    return F.when(days.isNull(), F.lit(unknown)).otherwise(out)


FRESHNESS = [(3, "NEW"), (7, "FRESH"), (14, "RECENT"), (30, "AGING")]


def due(status: Column, hours: Column, ttl: dict[str, int], default: int) -> Column:
    """Whether an attempt is to be repeated: its age reaches its status' span."""
    span = F.lit(default)
    for name, most in ttl.items():
        span = F.when(F.coalesce(status, F.lit("")) == name, F.lit(most)).otherwise(span)
    return hours.isNull() | (hours >= span)
