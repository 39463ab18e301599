"""Derived columns: counts, content class, engagement, timestamps, handles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content-class boundaries in seconds (inclusive upper bounds) and labels.
SHORT_MAX_SECONDS = 60
MEDIUM_MAX_SECONDS = 300
SHORT, MEDIUM, LONG = "Short", "Medium", "Long"

# Stored ratio precision NUMERIC(10,4).
RATIO_TYPE = "decimal(10,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_from_text(c, strict_present=None, name: str = "count") -> Column:
    """Text count -> BIGINT.  A missing value is 0; the cast is strict (ANSI raises).

    ``strict_present`` is an optional boolean column telling that the key was present in
    the source object; a present key holding JSON null then fails the query, as
    ``int(None)`` does in the reference.
    """
    c = _col(c)
    value = F.coalesce(c, F.lit("0")).cast("bigint")
    if strict_present is None:
        return value
    return F.when(strict_present & c.isNull(),
                  F.raise_error(F.lit(f"explicit null in {name}")).cast("bigint")).otherwise(value)


def null_safe_count(c) -> Column:
    return F.coalesce(_col(c), F.lit(0).cast("bigint"))


def content_type(seconds) -> Column:
    """<= 60 s Short, <= 300 s Medium, otherwise (and NULL) Long."""
    s = _col(seconds)
    return (F.when(s <= SHORT_MAX_SECONDS, F.lit(SHORT))
             .when(s <= MEDIUM_MAX_SECONDS, F.lit(MEDIUM))
             .otherwise(F.lit(LONG)))


def is_short(seconds) -> Column:
    """TRUE when <= 60 s; NULL seconds -> FALSE."""
    return F.coalesce(_col(seconds) <= SHORT_MAX_SECONDS, F.lit(False))


def engagement_ratio(likes, comments, views) -> Column:
    """(likes + comments) / views when views > 0 else 0, as DECIMAL(10,4).

    Exact decimal division, rounded half away from zero at 4 places on the final cast.
    A ratio of 10^6 or more does not fit and fails the query (ANSI).
    """
    l, c, v = null_safe_count(likes), null_safe_count(comments), null_safe_count(views)
    ratio = (l + c).cast("decimal(20,0)") / v.cast("decimal(20,0)")
    return F.when(v > 0, ratio).otherwise(F.lit(0)).cast(RATIO_TYPE)


def parse_published_at(c, strict: bool = True) -> Column:
    """ISO-8601 text (``Z`` or offset) -> TIMESTAMP_NTZ holding UTC wall-clock, whatever the
    session zone; text without a zone keeps its wall clock.  NULL fails the query when ``strict``.
    """
    c = _col(c)
    aware = c.rlike(r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.to_timestamp(c).cast("timestamp_ntz"))
    parsed = F.when(aware, utc).otherwise(F.to_timestamp_ntz(c))
    if not strict:
        return parsed
    return F.when(c.isNull(), F.raise_error(F.lit("published_at is null")).cast("timestamp_ntz")).otherwise(parsed)


def parse_extraction_date(c) -> Column:
    """Naive local ISO timestamp (microseconds) -> TIMESTAMP_NTZ; missing fails."""
    c = _col(c)
    return F.when(c.isNull(), F.raise_error(F.lit("extraction_date is missing")).cast("timestamp_ntz")) \
            .otherwise(F.to_timestamp_ntz(c))


def strip_handle(c) -> Column:
    """Remove every leading ``@`` from a channel handle."""
    return F.regexp_replace(_col(c), r"^@+", "")


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive ``datetime`` (wall clock, no zone involved).

    ``F.lit(datetime)`` would read a naive value in the Python process's zone and cast it
    back in the session zone; going through ISO text keeps the wall clock whatever the
    two zones are."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
