"""Duration conversions: ISO-8601 ``PT#H#M#S`` <-> seconds <-> ``H:MM:SS`` / ``M:SS``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the duration pattern.  It is matched as a prefix (anchored at the start
# only), so trailing text is ignored and anything not starting with "PT" is 0.  ASCII
# digits only.
ISO_PATTERN = r"^PT(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _group(c: Column, idx: int) -> Column:
    # regexp_extract yields '' for a non-matching string and for an unmatched optional
    # group; both count as 0.
    part = F.regexp_extract(c, ISO_PATTERN, idx)
    return F.coalesce(F.nullif(part, F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))


def iso8601_to_seconds(c) -> Column:
    """``PT1H2M3S`` -> 3723 (INT).  NULL, empty or non-matching input -> 0."""
    c = _col(c)
    total = _group(c, 1) * 3600 + _group(c, 2) * 60 + _group(c, 3)
    return F.when(c.isNull(), F.lit(0)).otherwise(total.cast("int"))


def seconds_to_readable(c) -> Column:
    """Seconds -> ``H:MM:SS`` when at least one hour, else ``M:SS``; hours unbounded.

    Floor division, so negative input formats the way Python's ``divmod`` does.
    """
    s = _col(c).cast("bigint")
    rem = F.pmod(s, F.lit(3600))
    hours = ((s - rem) / 3600).cast("bigint")
    minutes = F.floor(rem / 60).cast("bigint")
    secs = F.pmod(rem, F.lit(60))
    return (F.when(hours != 0, F.format_string("%d:%02d:%02d", hours, minutes, secs))
             .otherwise(F.format_string("%d:%02d", minutes, secs)))


def seconds_to_iso8601(c) -> Column:
    """Seconds -> ``PT#H#M#S`` with zero parts left out (0 -> ``PT``)."""
    s = _col(c).cast("bigint")
    h = F.floor(s / 3600)
    m = F.floor(F.pmod(s, F.lit(3600)) / 60)
    sec = F.pmod(s, F.lit(60))
    part = lambda v, unit: F.when(v > 0, F.concat(v.cast("string"), F.lit(unit))).otherwise(F.lit(""))
    return F.concat(F.lit("PT"), part(h, "H"), part(m, "M"), part(sec, "S"))


def readable_to_seconds(c) -> Column:
    """``H:MM:SS`` -> seconds when the text has two colons, else ``M:SS``.

    Parts are cast strictly (ANSI): ``'45'`` has no second part, so ``''`` fails the
    query, as in the reference.  NULL stays NULL.  A fourth part is ignored.
    """
    c = _col(c)
    p = lambda i: F.split_part(c, F.lit(":"), F.lit(i)).cast("int")
    return (F.when(c.like("%:%:%"), p(1) * 3600 + p(2) * 60 + p(3))
             .otherwise(p(1) * 60 + p(2)))
