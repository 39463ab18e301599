"""Snapshot envelope -> staging rows (unnest, typed counts, timestamps, raw JSON)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.functions.columns import ntz, count_from_text, parse_extraction_date, parse_published_at

STAGING_COLUMNS = [f.name for f in schemas.STAGING.fields]


def explode_envelope(envelopes: DataFrame, loaded_at: dt.datetime | None = None,
                     strict: bool = False) -> DataFrame:
    """Unnest ``videos`` of raw envelopes (``schemas.ENVELOPE_RAW``) into staging rows.

    Envelope fields repeat on every row; an envelope without one of them fails.  ``extraction_id`` is not assigned here (the
    sink does it at append time).  Counts: a missing key is 0; with ``strict`` a key that
    is present with JSON null fails the query, as the reference does.  ``published_at``
    must be present.  ``raw_data`` keeps each video object's JSON text.
    """
    def required(name: str, kind: str):
        missing = F.raise_error(F.lit(f"envelope without {name}")).cast(kind)
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name))

    rows = envelopes.select(
        required("channel_handle", "string").alias("channel_handle"),
        parse_extraction_date("extraction_date").alias("extraction_date"),
        required("total_videos", "int").alias("total_videos"),
        F.explode(required("videos", "array<string>")).alias("raw_data"),
    )
    video = F.from_json("raw_data", schemas.VIDEO_RECORD)
    rows = rows.withColumn("v", video)
    if strict:
        rows = rows.withColumn("keys", F.json_object_keys("raw_data"))
        present = lambda k: F.array_contains(F.col("keys"), k)
    else:
        present = lambda k: None
    loaded = ntz(loaded_at) if loaded_at else F.localtimestamp()
    vid = F.col("v.video_id")
    return rows.select(
        F.col("channel_handle"),
        F.col("extraction_date"),
        F.col("total_videos"),
        F.when(vid.isNull(), F.raise_error(F.lit("video_id is missing")).cast("string")).otherwise(vid).alias("video_id"),
        F.col("v.title").alias("title"),
        F.col("v.duration").alias("duration"),
        F.col("v.duration_readable").alias("duration_readable"),
        count_from_text("v.like_count", present("like_count"), "like_count").alias("like_count"),
        count_from_text("v.view_count", present("view_count"), "view_count").alias("view_count"),
        count_from_text("v.comment_count", present("comment_count"), "comment_count").alias("comment_count"),
        parse_published_at("v.published_at").alias("published_at"),
        F.col("raw_data"),
        loaded.alias("loaded_at"),
    )


def raw_fields(rows: DataFrame, raw_col: str = "raw_data", fields=tuple(schemas.VIDEO_FIELDS), keep=()) -> DataFrame:
    """Every field of the kept JSON objects as a row ``(*keep, field, state, value)``.

    The text is parsed once into a VARIANT; ``state`` tells a key that is ``missing`` from one that holds
    JSON ``null`` and from a ``value`` (as text).  Text that is no JSON fails the query."""
    parsed = rows.select(*keep, F.parse_json(raw_col).alias("_raw"))

    def field(name: str):
        at = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        got = F.try_variant_get("_raw", at, "variant")
        state = F.when(got.isNull(), "missing").when(F.is_variant_null(got), "null").otherwise("value")
        return F.struct(F.lit(name).alias("field"), state.alias("state"), F.try_variant_get("_raw", at, "string").alias("value"))

    return parsed.select(*keep, F.inline(F.array(*[field(n) for n in fields])))
