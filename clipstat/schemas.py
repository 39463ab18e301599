"""Explicit schemas for every input and table.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---- raw API responses (landed pages) -------------------------------------------------

CHANNELS_RESPONSE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", S),
        T.StructField("contentDetails", T.StructType([
            T.StructField("relatedPlaylists", T.StructType([T.StructField("uploads", S)])),
        ])),
    ]))),
])

PLAYLIST_PAGE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("snippet", T.StructType([
            T.StructField("resourceId", T.StructType([T.StructField("videoId", S)])),
        ])),
    ]))),
    T.StructField("nextPageToken", S),
])

# A video item keeps snippet / statistics / contentDetails as string maps so that a key
# that is absent can be told apart from a key that is present with a JSON null.
VIDEO_ITEM = T.StructType([
    T.StructField("id", S),
    T.StructField("snippet", T.MapType(S, S)),
    T.StructField("statistics", T.MapType(S, S)),
    T.StructField("contentDetails", T.MapType(S, S)),
])

VIDEOS_PAGE = T.StructType([T.StructField("items", T.ArrayType(VIDEO_ITEM))])

# ---- flattened video record (all strings, as written to the snapshot envelope) ---------

VIDEO_FIELDS = ["title", "duration", "video_id", "like_count", "view_count",
                "published_at", "comment_count", "duration_readable"]

VIDEO_RECORD = T.StructType([T.StructField(name, S) for name in VIDEO_FIELDS])

# Envelope as read for staging: videos kept as raw JSON text so key presence and the
# original object (raw_data) survive.
ENVELOPE_RAW = T.StructType([
    T.StructField("channel_handle", S),
    T.StructField("extraction_date", S),
    T.StructField("total_videos", T.IntegerType()),
    T.StructField("videos", T.ArrayType(S)),
])

ENVELOPE = T.StructType([
    T.StructField("channel_handle", S),
    T.StructField("extraction_date", T.TimestampNTZType()),
    T.StructField("total_videos", T.IntegerType()),
    T.StructField("videos", T.ArrayType(VIDEO_RECORD)),
])

# ---- tables -----------------------------------------------------------------------------

STAGING = T.StructType([
    T.StructField("extraction_id", T.LongType(), False),
    T.StructField("channel_handle", S),
    T.StructField("extraction_date", T.TimestampNTZType()),
    T.StructField("total_videos", T.IntegerType()),
    T.StructField("video_id", S, False),
    T.StructField("title", S),
    T.StructField("duration", S),
    T.StructField("duration_readable", S),
    T.StructField("like_count", T.LongType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("raw_data", S),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

CORE_COLUMNS = ["video_id", "title", "duration_seconds", "duration_formatted", "like_count",
                "view_count", "comment_count", "published_at", "channel_handle", "content_type",
                "engagement_ratio", "is_short", "extraction_date"]

CORE = T.StructType([
    T.StructField("video_id", S, False),
    T.StructField("title", S, False),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("duration_formatted", S),
    T.StructField("like_count", T.LongType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("channel_handle", S),
    T.StructField("content_type", S),
    T.StructField("engagement_ratio", T.DecimalType(10, 4)),
    T.StructField("is_short", T.BooleanType()),
    T.StructField("extraction_date", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

HISTORY = T.StructType([
    T.StructField("history_id", T.LongType(), False),
    T.StructField("video_id", S),
    T.StructField("like_count", T.LongType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
])

# What a run did: one row for each step (and, in a stream, each extraction).
AUDIT = T.StructType([
    T.StructField("stage", S),
    T.StructField("rows", T.LongType()),
    T.StructField("detail", S),
    T.StructField("at", T.TimestampNTZType()),
])

# Column length limits of the reference's DDL, enforced before every write.
# VARCHAR widths of the three tables.
VARCHAR_LIMITS = {
    "staging": {"channel_handle": 100, "video_id": 20, "duration": 20, "duration_readable": 20},
    "core": {"video_id": 20, "duration_formatted": 20, "channel_handle": 100, "content_type": 50},
    "history": {"video_id": 20},
}

# NOT NULL columns of the reference's DDL.
NOT_NULL = {
    "staging": ["extraction_id", "video_id"],
    "core": ["video_id", "title"],
    "history": ["history_id"],
}
