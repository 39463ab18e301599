"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole generated tables through the fixture views and runs the
library's operators on them; ``clipstat.plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.functions import columns
from clipstat.functions.durations import iso8601_to_seconds, readable_to_seconds, seconds_to_readable
from clipstat.operators import core as core_ops
from clipstat.operators import extract, history, merge, quality
from clipstat.operators.staging import explode_envelope, raw_fields
from clipstat.plans import fixtures as fx
from clipstat.sinks.envelope import build_envelopes

def _ctx(spark: SparkSession, d: str) -> fx.Fixtures:
    return fx.Fixtures(spark, d)


def _stg(c: fx.Fixtures) -> DataFrame:
    return c.view(("stg",), lambda: fx.stg(c.spark, c.sf_dir, fx=c))


def _snapshot(c: fx.Fixtures) -> DataFrame:
    return c.view(("snapshot",), lambda: fx.snapshot(c.spark, c.sf_dir, c), staged=True)


def _history_before(c: fx.Fixtures) -> DataFrame:
    return c.view(("history_before",), lambda: fx.history_rows(_snapshot(c)))


STG_COLUMNS = ["extraction_id", "channel_handle", "extraction_date", "video_id", "title", "duration",
               "duration_readable", "like_count", "view_count", "comment_count", "published_at", "loaded_at"]
DETAIL_COLUMNS = ["page_no", "pos", "video_id", "title", "duration", "like_count", "view_count",
                  "published_at", "comment_count", "duration_readable"]
HISTORY_OUT = ["video_id", "like_count", "view_count", "comment_count", "recorded_at"]


# ---- extraction ------------------------------------------------------------------------

def flatten_items(spark: SparkSession, d: str) -> DataFrame:
    return extract.flatten_video_items(fx.items(spark, d)).select(*schemas.VIDEO_FIELDS)


def iso_to_seconds(spark: SparkSession, d: str) -> DataFrame:
    flat = extract.flatten_video_items(fx.items(spark, d))
    return flat.select("video_id", "duration", iso8601_to_seconds("duration").alias("duration_seconds"))


def seconds_to_readable_q(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events").withColumn("_secs", fx.event_seconds(F.col("event_id")))
    secs = F.col("_secs")
    return e.select(F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("video_id"),
                    secs.cast("int").alias("duration_seconds"),
                    seconds_to_readable(secs).alias("duration_readable"))


def readable_to_seconds_q(spark: SparkSession, d: str) -> DataFrame:
    return fx.stg(spark, d).select("extraction_id", "duration_readable",
                                   readable_to_seconds("duration_readable").alias("duration_seconds"))


def playlist_ids(spark: SparkSession, d: str) -> DataFrame:
    return extract.playlist_video_ids(fx.pages(spark, d))


def page_stop(spark: SparkSession, d: str) -> DataFrame:
    """One playlist: the crawl ends at the last page without ids or without a token."""
    return _crawled(_ctx(spark, d)).select("page_no", "n_ids", F.col("nextPageToken").alias("next_page_token"))


def _crawled(c: fx.Fixtures) -> DataFrame:
    """Heads of the pages that one playlist's crawl reads; the pages are built once."""
    heads = c.view(("heads",), lambda: extract.page_heads(fx.pages(c.spark, c.sf_dir, c)), staged=True)
    return extract.crawled_pages(fx.one_playlist(heads))


def _detail_join(c: fx.Fixtures, staged: bool = False) -> DataFrame:
    def build():
        return extract.page_videos(_crawled(c), fx.detail_pages(c.spark, c.sf_dir, c)).select(*DETAIL_COLUMNS)

    return c.view(("details",), build, staged)


def detail_join(spark: SparkSession, d: str) -> DataFrame:
    return _detail_join(_ctx(spark, d))


def first_n_videos(spark: SparkSession, d: str) -> DataFrame:
    return extract.first_n(_detail_join(_ctx(spark, d)), fx.MAX_RESULTS)


def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.extraction_summary(_detail_join(_ctx(spark, d)), fx.MAX_RESULTS)


def _channel_videos(c: fx.Fixtures) -> DataFrame:
    """Every playlist's crawl: both stop rules cut some playlist.  The keys of the crawled pages are
    staged, so that their size and not that of all pages decides how the responses are joined."""
    by = ["playlist_id"]
    heads = c.view(("all_heads",), lambda: extract.page_heads(fx.pages(c.spark, c.sf_dir, c), by), staged=True)
    crawl = c.view(("crawl",), lambda: extract.crawled_pages(heads, by).select(*by, "page_no"), staged=True)
    return extract.page_videos(crawl, fx.detail_pages(c.spark, c.sf_dir, c), by)


def channel_extract(spark: SparkSession, d: str) -> DataFrame:
    """First videos of every playlist."""
    return extract.first_n(_channel_videos(_ctx(spark, d)), fx.CHANNEL_RESULTS, ["playlist_id"]).select(
        "playlist_id", *DETAIL_COLUMNS)


def channel_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.extraction_summary(_channel_videos(_ctx(spark, d)), fx.CHANNEL_RESULTS, ["playlist_id"])


def channel_lookup(spark: SparkSession, d: str) -> DataFrame:
    return extract.resolve_channels(fx.requests(spark, d), fx.channels(spark, d)).select(
        "request_id", "channel_handle", "channel_id", "uploads_playlist_id")


# ---- transform -------------------------------------------------------------------------

def latest_extraction(spark: SparkSession, d: str) -> DataFrame:
    return core_ops.latest_extraction(fx.stg(spark, d)).select(*STG_COLUMNS)


def dedupe_newest(spark: SparkSession, d: str) -> DataFrame:
    return core_ops.dedupe_newest(core_ops.latest_extraction(fx.stg(spark, d))).select(*STG_COLUMNS)


def core_projection(spark: SparkSession, d: str) -> DataFrame:
    return fx.snapshot(spark, d)


def content_type(spark: SparkSession, d: str) -> DataFrame:
    secs = readable_to_seconds("duration_readable")
    return fx.stg(spark, d).select("extraction_id", secs.alias("duration_seconds")).select(
        "extraction_id", "duration_seconds", columns.content_type("duration_seconds").alias("content_type"),
        columns.is_short("duration_seconds").alias("is_short"))


def engagement_ratio(spark: SparkSession, d: str) -> DataFrame:
    return fx.stg(spark, d).select(
        "extraction_id", "like_count", "comment_count", "view_count",
        columns.engagement_ratio("like_count", "comment_count", "view_count").alias("engagement_ratio"))


def _staged(spark: SparkSession, d: str) -> DataFrame:
    raw = fx.envelopes(spark, d).select(F.from_json("value", schemas.ENVELOPE_RAW, {"mode": "FAILFAST"}).alias("e")).select("e.*")
    return explode_envelope(raw, loaded_at=fx.AS_OF)


def raw_fields_q(spark: SparkSession, d: str) -> DataFrame:
    """Every key of every video object kept in ``raw_data``: its value, null, or missing."""
    return raw_fields(_staged(spark, d), keep=("channel_handle", "video_id"))


def staging_rows(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes as JSON text -> all staging columns (the raw JSON by the id it carries)."""
    return _staged(spark, d).withColumn(
        "raw_video_id", F.get_json_object("raw_data", "$.video_id")).drop("raw_data")


def _merged(c: fx.Fixtures, refresh=(), staged: bool = False) -> DataFrame:
    return c.view(("merged", tuple(refresh)), lambda: merge.upsert(
        fx.core_before(c.spark, c.sf_dir, c), _snapshot(c), fx.AS_OF, refresh=refresh), staged)


def upsert_core_sticky(spark: SparkSession, d: str) -> DataFrame:
    return _merged(_ctx(spark, d))


def upsert_core_refresh(spark: SparkSession, d: str) -> DataFrame:
    return _merged(_ctx(spark, d), refresh=("extraction_date",))


def _new_history(c: fx.Fixtures, refresh=(), staged: bool = False) -> DataFrame:
    return c.view(("new_history", tuple(refresh)), lambda: history.new_history_rows(
        _merged(c, refresh, staged), _stg(c), _history_before(c), fx.AS_OF).select(*HISTORY_OUT), staged)


def history_append_sticky(spark: SparkSession, d: str) -> DataFrame:
    return _new_history(_ctx(spark, d))


def history_append_refresh(spark: SparkSession, d: str) -> DataFrame:
    return _new_history(_ctx(spark, d), ("extraction_date",))


def _history_after(c: fx.Fixtures) -> DataFrame:
    """Old and new history; core and the new rows are work tables here, as several metrics read them."""
    return c.view(("history_after",), lambda: _history_before(c).select(*HISTORY_OUT)
                  .unionByName(_new_history(c, staged=True)))


def history_today_count(spark: SparkSession, d: str) -> DataFrame:
    c = _ctx(spark, d)
    after = _history_after(c)
    return history.today_counts(_merged(c), after, fx.AS_OF)


# ---- quality ---------------------------------------------------------------------------

def _pipeline_tables(c: fx.Fixtures) -> dict[str, DataFrame]:
    after = _history_after(c)
    return {"staging": _stg(c), "core": _merged(c), "history": after}


def dq_row_count(spark: SparkSession, d: str) -> DataFrame:
    c = _ctx(spark, d)
    tables = dict(_pipeline_tables(c), dq_docs=fx.dq_docs(spark, d, c))
    parts = [quality.compute_metrics(df, name, [("row_count", None)]) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DQ_MISSING = [("missing_count", c) for c in ("text", "lang", "source", "quality", "toxic")]
DQ_DUPLICATES = [("duplicate_count", c) for c in ("text", "source", "lang", "n_chars")]
DQ_MIN_MAX = [(m, c) for c in ("doc_id", "n_chars", "quality", "toxic") for m in ("min", "max")]
DQ_MAX_LENGTH = [("max_length", c) for c in ("text", "lang", "source")]


def dq_missing(spark: SparkSession, d: str) -> DataFrame:
    return quality.compute_metrics(fx.dq_docs(spark, d), "dq_docs", DQ_MISSING)


def dq_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return quality.compute_metrics(fx.dq_docs(spark, d), "dq_docs", DQ_DUPLICATES)


def dq_min_max(spark: SparkSession, d: str) -> DataFrame:
    return quality.compute_metrics(fx.dq_docs(spark, d), "dq_docs", DQ_MIN_MAX)


def dq_max_length(spark: SparkSession, d: str) -> DataFrame:
    return quality.compute_metrics(fx.dq_docs(spark, d), "dq_docs", DQ_MAX_LENGTH)


def dq_check_set(spark: SparkSession, d: str) -> DataFrame:
    return quality.run_checks(_pipeline_tables(_ctx(spark, d)), quality.DEFAULT_CHECKS)


# Checks whose outcomes differ: every comparator on both sides of the value, and a table without rows.
OUTCOME_CHECKS = [quality.Check(t, m, c, op, float(th), quality.check_name(t, m, c, op, th)) for t, m, c, op, th in [
    *(("dq_docs", "min", "doc_id", op, th) for op in quality.COMPARATORS for th in (-1, 0, 1)),
    *(("dq_docs", "max", "quality", op, th) for op in quality.COMPARATORS for th in (0, 1, 2)),
    ("dq_docs", "row_count", None, ">", 0), ("dq_docs", "row_count", None, "<", 10), ("dq_docs", "missing_count", "toxic", "=", 0),
    ("dq_docs", "missing_count", "doc_id", "=", 0), ("dq_docs", "duplicate_count", "source", "!=", 0), ("dq_docs", "max_length", "text", "<=", 200),
    ("none", "row_count", None, ">", 0), ("none", "row_count", None, "=", 0), ("none", "missing_count", "text", "=", 0),
    ("none", "duplicate_count", "text", "=", 0), ("none", "min", "n_chars", ">=", 0), ("none", "max", "n_chars", "<=", 90000),
    ("none", "max_length", "text", "<=", 200)]]


def dq_outcomes(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.dq_docs(spark, d)
    return quality.run_checks({"dq_docs": docs, "none": docs.where(F.col("n_chars") < 0)}, OUTCOME_CHECKS)


# ---- sink ------------------------------------------------------------------------------

ENVELOPE_CHUNK_ROWS = 100_000


def _envelope_lines(c: fx.Fixtures) -> DataFrame:
    """An envelope per (channel, extraction, chunk) from staged rows, as the JSON text that a
    snapshot holds (column ``value``)."""
    text = _stg(c).select("channel_handle", "extraction_date", "extraction_id",
                          *[F.col(x).cast("string").alias(x) for x in schemas.VIDEO_FIELDS])
    env = build_envelopes(text, ["extraction_id"], F.floor(F.col("extraction_id") / ENVELOPE_CHUNK_ROWS))
    return env.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def _read_back(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", schemas.ENVELOPE, {"mode": "FAILFAST"}).alias("e")).select(
        "e.channel_handle", F.to_timestamp_ntz("e.extraction_date").alias("extraction_date"), "e.total_videos", "e.videos")


def snapshot_envelope_counts(spark: SparkSession, d: str) -> DataFrame:
    """Declared ``total_videos`` of the serialised envelopes next to the videos they carry."""
    back = _read_back(_envelope_lines(_ctx(spark, d)))
    return back.groupBy("channel_handle", "extraction_date").agg(
        F.max("total_videos").alias("total_videos"), F.sum(F.size("videos")).cast("bigint").alias("n_videos"))


def envelope_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every video field after serialising the envelopes and parsing them again."""
    back = _read_back(_envelope_lines(_ctx(spark, d)))
    return back.select("channel_handle", "extraction_date", "total_videos", F.explode("videos").alias("v")).select(
        "channel_handle", "extraction_date", "total_videos", "v.*")


QUERIES = {
    "flatten_items": flatten_items,
    "iso_to_seconds": iso_to_seconds,
    "seconds_to_readable": seconds_to_readable_q,
    "readable_to_seconds": readable_to_seconds_q,
    "playlist_ids": playlist_ids,
    "page_stop": page_stop,
    "detail_join": detail_join,
    "first_n_videos": first_n_videos,
    "extraction_summary": extraction_summary,
    "channel_extract": channel_extract,
    "channel_summary": channel_summary,
    "channel_lookup": channel_lookup,
    "staging_rows": staging_rows,
    "raw_fields": raw_fields_q,
    "latest_extraction": latest_extraction,
    "dedupe_newest": dedupe_newest,
    "core_projection": core_projection,
    "content_type": content_type,
    "engagement_ratio": engagement_ratio,
    "upsert_core_sticky": upsert_core_sticky,
    "upsert_core_refresh": upsert_core_refresh,
    "history_append_sticky": history_append_sticky,
    "history_append_refresh": history_append_refresh,
    "history_today_count": history_today_count,
    "dq_row_count": dq_row_count,
    "dq_missing": dq_missing,
    "dq_duplicates": dq_duplicates,
    "dq_min_max": dq_min_max,
    "dq_max_length": dq_max_length,
    "dq_check_set": dq_check_set,
    "dq_outcomes": dq_outcomes,
    "snapshot_envelope_counts": snapshot_envelope_counts,
    "envelope_roundtrip": envelope_roundtrip,
}
