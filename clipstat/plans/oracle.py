"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark operators: where the fixture knows the true value
(e.g. the seconds a duration text was made from) the oracle uses it instead of parsing,
and the upsert / history / checks are plain SQL (full outer join, NOT EXISTS,
GROUP BY ... HAVING).  Views ``orders lineitem part events ...`` are registered by the
caller.
"""

from __future__ import annotations

import datetime as dt

from clipstat.operators.quality import DEFAULT_CHECKS
from clipstat.plans import fixtures as fx
from clipstat.plans import registry as reg

AS_OF = f"TIMESTAMP '{fx.AS_OF:%Y-%m-%d %H:%M:%S}'"
AS_OF_DATE = f"DATE '{fx.AS_OF:%Y-%m-%d}'"
DAY_BEFORE = f"TIMESTAMP '{fx.AS_OF - dt.timedelta(days=1):%Y-%m-%d %H:%M:%S}'"
PRIOR_RUN = f"TIMESTAMP '{fx.PRIOR_RUN:%Y-%m-%d %H:%M:%S}'"


def _readable(s: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} >= 3600 THEN printf('%d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60) "
            f"ELSE printf('%d:%02d', {s} // 60, {s} % 60) END")


def _iso(s: str) -> str:
    h, m, x = f"({s} // 3600)", f"(({s} % 3600) // 60)", f"({s} % 60)"
    part = lambda v, u: f"CASE WHEN {v} > 0 THEN CAST({v} AS VARCHAR) || '{u}' ELSE '' END"
    return f"CASE WHEN {s} IS NOT NULL THEN ('PT' || {part(h, 'H')} || {part(m, 'M')} || {part(x, 'S')}) END"


def _ratio(l: str, c: str, v: str) -> str:
    l, c = f"coalesce({l}, 0)", f"coalesce({c}, 0)"
    return (f"CASE WHEN {v} > 0 THEN CAST(CAST((({l} + {c}) * 20000 + {v}) // (2 * {v}) AS DOUBLE) / 10000 "
            f"AS DECIMAL(10,4)) ELSE CAST(0 AS DECIMAL(10,4)) END")


_CORE_COLS = ("video_id, title, duration_seconds, duration_formatted, like_count, view_count, comment_count, "
              "published_at, channel_handle, content_type, engagement_ratio, is_short, extraction_date")
_STG_COLS = ", ".join(reg.STG_COLUMNS)
_DETAILS = ", ".join(reg.DETAIL_COLUMNS)


_PROJ = f"""video_id, title, CAST(secs AS INTEGER) AS duration_seconds, duration_readable AS duration_formatted,
         coalesce(like_count, 0) AS like_count, coalesce(view_count, 0) AS view_count,
         coalesce(comment_count, 0) AS comment_count, published_at, channel_handle,
         CASE WHEN secs <= 60 THEN 'Short' WHEN secs <= 300 THEN 'Medium' ELSE 'Long' END AS content_type,
         {_ratio('like_count', 'comment_count', 'view_count')} AS engagement_ratio,
         coalesce(secs <= 60, FALSE) AS is_short, extraction_date"""


def _merge_sql(refresh: bool) -> str:
    ext = "CASE WHEN s.video_id IS NOT NULL THEN s.extraction_date ELSE t.extraction_date END" if refresh else \
          "CASE WHEN t.video_id IS NOT NULL THEN t.extraction_date ELSE s.extraction_date END"
    upd = lambda c: f"CASE WHEN s.video_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
    keep = lambda c: f"CASE WHEN t.video_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}"
    cols = ["COALESCE(s.video_id, t.video_id) AS video_id", upd("title"), upd("duration_seconds"),
            upd("duration_formatted"), upd("like_count"), upd("view_count"), upd("comment_count"),
            keep("published_at"), keep("channel_handle"), upd("content_type"), upd("engagement_ratio"),
            upd("is_short"), f"{ext} AS extraction_date",
            f"CASE WHEN s.video_id IS NOT NULL THEN {AS_OF} ELSE t.updated_at END AS updated_at"]
    return f"SELECT {', '.join(cols)} FROM core_before t FULL OUTER JOIN snap s ON t.video_id = s.video_id"


def _history_new(merged: str) -> str:
    return (f"SELECT m.video_id, m.like_count, m.view_count, m.comment_count, {AS_OF} AS recorded_at "
            f"FROM {merged} m WHERE m.extraction_date = (SELECT max(extraction_date) FROM stg) "
            f"AND NOT EXISTS (SELECT 1 FROM history_before h WHERE h.video_id = m.video_id "
            f"AND CAST(h.recorded_at AS DATE) = {AS_OF_DATE})")


CTES = f"""
stg_src AS (
  SELECT *, CASE WHEN o_orderkey % 37 = 5 THEN NULL WHEN o_orderkey % 3 = 0 THEN (o_orderkey * 7919) % 5400
                 ELSE (o_orderkey * 31) % 400 END AS secs
  FROM orders),
stg AS (
  SELECT o_orderkey AS extraction_id, '@' || o_orderstatus AS channel_handle,
         make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) AS extraction_date,
         'v' || CAST(o_custkey AS VARCHAR) AS video_id, o_orderpriority AS title,
         {_iso('secs')} AS duration, {_readable('secs')} AS duration_readable,
         CASE WHEN o_orderkey % 23 <> 1 THEN o_orderkey % 77 END AS like_count,
         CASE WHEN o_orderkey % 29 = 2 THEN NULL WHEN o_orderkey % 41 = 7 THEN -(o_orderkey % 7) - 1
              WHEN o_orderkey % 10 = 9 THEN o_orderkey % 50 ELSE (o_orderkey % 1000) * 100 END AS view_count,
         CASE WHEN o_orderkey % 31 <> 3 THEN o_orderkey % 13 END AS comment_count,
         CASE WHEN o_orderkey % 43 <> 8 THEN o_orderdate END AS published_at,
         CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS loaded_at, secs
  FROM stg_src),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY video_id, extraction_date
                               ORDER BY loaded_at DESC, extraction_id DESC) AS rn
  FROM stg),
newest AS (SELECT max(extraction_date) AS d FROM stg),
earlier AS (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY loaded_at DESC, extraction_id DESC) AS rn
  FROM stg, newest WHERE extraction_date < d AND video_id NOT LIKE '%7'),
snap AS (SELECT {_PROJ} FROM ranked, newest WHERE rn = 1 AND extraction_date = d),
core_before AS (SELECT {_PROJ}, {PRIOR_RUN} AS updated_at FROM earlier WHERE rn = 1),
merged_sticky AS ({_merge_sql(False)}),
merged_refresh AS ({_merge_sql(True)}),
history_before AS (
  SELECT video_id, like_count, view_count, comment_count, {AS_OF} AS recorded_at FROM snap WHERE like_count % 2 = 0
  UNION ALL
  SELECT video_id, like_count, view_count, comment_count, {DAY_BEFORE} FROM snap WHERE like_count % 3 = 0),
hist_new_sticky AS ({_history_new('merged_sticky')}),
hist_new_refresh AS ({_history_new('merged_refresh')}),
history_after AS (SELECT * FROM history_before UNION ALL SELECT * FROM hist_new_sticky),
ev_src AS (SELECT *, (event_id * 7919) % 90000 AS whole FROM events),
ev AS (
  SELECT *, CASE event_id % 17 WHEN 0 THEN 'PT' || (event_id % 50) || '.5S' WHEN 1 THEN 'P1DT2H'
              WHEN 2 THEN 'PT' || (event_id % 50 + 1) || 'S2M' WHEN 3 THEN NULL
              WHEN 4 THEN 'PT' || (event_id % 20 + 1) || 'H or so' ELSE {_iso('whole')} END AS duration,
         CASE event_id % 17 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN event_id % 50 + 1 WHEN 3 THEN 0
              WHEN 4 THEN (event_id % 20 + 1) * 3600 ELSE whole END AS secs
  FROM ev_src),
ids AS (
  SELECT l_orderkey AS page_no,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                 l_extendedprice, l_quantity) - 1 AS INTEGER) AS pos,
         CAST(l_partkey AS VARCHAR) AS video_id
  FROM lineitem WHERE l_orderkey % 97 <> 13),
det AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title, {_iso('d')} AS duration,
         CAST(p_size AS VARCHAR) AS like_count, CAST(p_size * 1000 AS VARCHAR) AS view_count,
         '2020-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS published_at,
         CAST(p_partkey % 17 AS VARCHAR) AS comment_count, {_readable('d')} AS duration_readable
  FROM (SELECT *, (p_partkey * 37) % 4000 AS d FROM part WHERE p_size % 10 <> 0)),
page AS (
  SELECT l_orderkey AS page_no, 'U' || (l_orderkey % {fx.PLAYLISTS}) AS playlist_id, count(*) AS n,
         l_orderkey % 97 = 13 AS is_empty, l_orderkey % 89 = 5 AS is_last
  FROM lineitem GROUP BY l_orderkey),
single_stop AS (
  SELECT least(max(page_no) FILTER (is_empty) - 1, max(page_no) FILTER (is_last)) AS stop FROM page),
single AS (
  SELECT page_no, n, is_last AND page_no = (SELECT max(page_no) FROM page WHERE is_last) AS ends FROM page, single_stop
  WHERE stop IS NULL OR page_no <= stop),
crawl AS (
  SELECT * FROM (SELECT *, count(*) FILTER (is_empty) OVER before + count(*) FILTER (is_last AND NOT is_empty) OVER earlier AS ended
                 FROM page WINDOW before AS (PARTITION BY playlist_id ORDER BY page_no),
                 earlier AS (PARTITION BY playlist_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE coalesce(ended, 0) = 0),
answer AS (
  SELECT page_no, CAST(row_number() OVER (PARTITION BY page_no ORDER BY p_partkey DESC) - 1 AS INTEGER) AS pos, det.*
  FROM (SELECT DISTINCT l_orderkey AS page_no, l_partkey FROM lineitem) JOIN det ON l_partkey = p_partkey),
joined AS (
  SELECT {_DETAILS} FROM answer JOIN single USING (page_no)),
channel_joined AS (
  SELECT playlist_id, {_DETAILS} FROM answer JOIN crawl USING (page_no)),
channel_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY page_no, pos) AS place,
         count(*) OVER (PARTITION BY playlist_id) AS total FROM channel_joined),
dq_docs AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def _with(select: str) -> str:
    return f"WITH {CTES.strip()}\n{select}"


def _metric_sql(table: str, source: str, metric: str, column: str | None) -> str:
    col = "NULL" if column is None else f"'{column}'"
    if metric == "row_count":
        value = f"(SELECT count(*) FROM {source})"
    elif metric == "missing_count":
        value = f"(SELECT count(*) FROM {source} WHERE {column} IS NULL)"
    elif metric == "duplicate_count":
        value = (f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
                 f"GROUP BY {column} HAVING count(*) > 1))")
    elif metric in ("min", "max"):
        value = f"(SELECT {metric}({column}) FROM {source})"
    elif metric == "max_length":
        value = f"(SELECT max(length({column})) FROM {source})"
    else:
        raise ValueError(metric)
    return (f"SELECT '{table}' AS table_name, '{metric}' AS metric, CAST({col} AS VARCHAR) AS column_name, "
            f"CAST({value} AS DECIMAL(38,4)) AS value")


def _metrics(table: str, source: str, metrics) -> str:
    return _with("\nUNION ALL\n".join(_metric_sql(table, source, m, c) for m, c in metrics))


_PIPELINE_SOURCES = {"staging": "stg", "core": "merged_sticky", "history": "history_after"}


def _raw_fields() -> str:
    """What each key of a video object holds, from the order it was made of."""
    time = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"
    keys = {"title": ("CASE WHEN o_orderkey % 13 <> 4 THEN o_orderpriority END", "o_orderkey % 11 <> 0"),
            "duration": ("'PT1M'", "TRUE"), "video_id": ("'v' || o_custkey", "TRUE"),
            "like_count": ("CAST(o_orderkey % 77 AS VARCHAR)", "o_orderkey % 5 <> 0"),
            "view_count": ("CASE WHEN o_orderkey % 17 <> 6 THEN CAST(o_orderkey % 1000 AS VARCHAR) END", "TRUE"),
            "published_at": (f"{time} || CASE o_orderkey % 4 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' WHEN 2 THEN '.123456Z' ELSE '' END", "TRUE"),
            "comment_count": ("CAST(o_orderkey % 13 AS VARCHAR)", "o_orderkey % 19 <> 3"), "duration_readable": ("'1:00'", "TRUE")}
    return "\nUNION ALL\n".join(
        f"SELECT channel_handle, video_id, field, CASE WHEN NOT there THEN 'missing' WHEN value IS NULL THEN 'null' ELSE 'value' END AS state, "
        f"CASE WHEN there THEN value END AS value FROM (SELECT '@' || o_orderstatus AS channel_handle, 'v' || o_custkey AS video_id, "
        f"'{k}' AS field, {value} AS value, {there} AS there FROM orders)" for k, (value, there) in keys.items())


def _check_set(checks=None, sources=None) -> str:
    ops = {">": ">", ">=": ">=", "<": "<", "<=": "<=", "=": "=", "!=": "<>"}
    rows = []
    for c in checks or DEFAULT_CHECKS:
        m = _metric_sql(c.table, (sources or _PIPELINE_SOURCES)[c.table], c.metric, c.column)
        name = c.name.replace("'", "''")
        rows.append(
            f"SELECT table_name, '{name}' AS check_name, metric, column_name, value, '{c.op}' AS comparator, "
            f"CAST({c.threshold!r} AS DECIMAL(38,4)) AS threshold, "
            f"CASE WHEN value IS NULL THEN 'not_evaluated' "
            f"WHEN value {ops[c.op]} CAST({c.threshold!r} AS DECIMAL(38,4)) THEN 'pass' ELSE 'fail' END AS outcome "
            f"FROM ({m})")
    return _with("\nUNION ALL\n".join(rows))


ORACLE = {
    "flatten_items": _with(
        "SELECT CASE WHEN event_id % 11 <> 0 THEN event_type ELSE '' END AS title, "
        "duration, 'v' || CAST(event_id AS VARCHAR) AS video_id, "
        "CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 97 AS VARCHAR) ELSE '0' END AS like_count, "
        "CAST(event_id % 1000 AS VARCHAR) AS view_count, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at, "
        "CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 13 AS VARCHAR) ELSE '0' END AS comment_count, "
        f"{_readable('secs')} AS duration_readable FROM ev"),
    "iso_to_seconds": _with(
        "SELECT 'v' || CAST(event_id AS VARCHAR) AS video_id, duration, CAST(secs AS INTEGER) AS duration_seconds FROM ev"),
    "seconds_to_readable": _with(
        "SELECT 'v' || CAST(event_id AS VARCHAR) AS video_id, CAST(whole AS INTEGER) AS duration_seconds, "
        f"{_readable('whole')} AS duration_readable FROM ev"),
    "readable_to_seconds": _with(
        "SELECT extraction_id, duration_readable, CAST(secs AS INTEGER) AS duration_seconds FROM stg"),
    "playlist_ids": _with("SELECT page_no, pos, video_id FROM ids"),
    "page_stop": _with(
        "SELECT page_no, CAST(CASE WHEN is_empty THEN 1 ELSE n END AS INTEGER) AS n_ids, CASE WHEN ends THEN NULL "
        "WHEN is_last THEN 'more' ELSE 'p' || CAST(page_no + 1 AS VARCHAR) END AS next_page_token "
        "FROM single JOIN (SELECT page_no, is_empty, is_last FROM page) USING (page_no)"),
    "detail_join": _with("SELECT * FROM joined"),
    "first_n_videos": _with(f"SELECT * FROM (SELECT * FROM joined ORDER BY page_no, pos LIMIT {fx.MAX_RESULTS})"),
    "extraction_summary": _with(
        f"SELECT videos_fetched, least(videos_fetched, {fx.MAX_RESULTS}) AS videos_returned, "
        "(videos_fetched // 50) * 2 AS quota_units FROM ("
        "SELECT count(*) AS videos_fetched FROM joined, "
        f"(SELECT max(page_no) AS p, count(*) AS k FROM (SELECT page_no FROM joined ORDER BY page_no, pos "
        f"LIMIT {fx.MAX_RESULTS})) nth WHERE nth.k < {fx.MAX_RESULTS} OR joined.page_no <= nth.p)"),
    "channel_extract": _with(
        f"SELECT playlist_id, {_DETAILS} FROM channel_ranked WHERE place <= {fx.CHANNEL_RESULTS}"),
    "channel_summary": _with(
        f"SELECT playlist_id, videos_fetched, least(videos_fetched, {fx.CHANNEL_RESULTS}) AS videos_returned, "
        "(videos_fetched // 50) * 2 AS quota_units FROM (SELECT playlist_id, count(*) AS videos_fetched FROM "
        f"channel_joined c WHERE page_no <= (SELECT max(page_no) FROM channel_ranked r WHERE r.playlist_id = c.playlist_id "
        f"AND place <= {fx.CHANNEL_RESULTS}) GROUP BY playlist_id)"),
    "channel_lookup": _with(
        "SELECT s.s_suppkey AS request_id, repeat('@', CAST(s.s_suppkey % 2 + 1 AS INTEGER)) || n.n_name || "
        "CASE WHEN s.s_suppkey % 5 = 0 THEN '?' ELSE '' END AS channel_handle, CAST(c.n_nationkey AS VARCHAR) AS channel_id, "
        "c.r_name AS uploads_playlist_id FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) c "
        "ON c.n_name = n.n_name AND s.s_suppkey % 5 <> 0"),
    "staging_rows": _with(
        "SELECT '@' || o_orderstatus AS channel_handle, "
        "make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0.5) AS extraction_date, "
        "CAST(count(*) OVER (PARTITION BY o_orderstatus, year(o_orderdate), o_orderkey // 1000) AS INTEGER) AS total_videos, "
        "'v' || CAST(o_custkey AS VARCHAR) AS video_id, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 4 "
        "THEN o_orderpriority END AS title, "
        "'PT1M' AS duration, '1:00' AS duration_readable, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 77 ELSE 0 END AS like_count, "
        "CASE WHEN o_orderkey % 17 <> 6 THEN o_orderkey % 1000 ELSE 0 END AS view_count, "
        "CASE WHEN o_orderkey % 19 <> 3 THEN o_orderkey % 13 ELSE 0 END AS comment_count, "
        "CASE o_orderkey % 4 WHEN 1 THEN o_orderdate - INTERVAL 330 MINUTE WHEN 2 THEN o_orderdate + INTERVAL 123456 MICROSECOND "
        f"ELSE o_orderdate END AS published_at, {AS_OF} AS loaded_at, 'v' || CAST(o_custkey AS VARCHAR) AS raw_video_id FROM orders"),
    "raw_fields": _raw_fields(),
    "latest_extraction": _with(
        f"SELECT {_STG_COLS} FROM stg WHERE extraction_date = (SELECT max(extraction_date) FROM stg)"),
    "dedupe_newest": _with(
        f"SELECT {_STG_COLS} FROM ranked WHERE rn = 1 "
        "AND extraction_date = (SELECT max(extraction_date) FROM stg)"),
    "core_projection": _with(f"SELECT {_CORE_COLS} FROM snap"),
    "content_type": _with(
        "SELECT extraction_id, CAST(secs AS INTEGER) AS duration_seconds, CASE WHEN secs <= 60 THEN 'Short' "
        "WHEN secs <= 300 THEN 'Medium' ELSE 'Long' END AS content_type, coalesce(secs <= 60, FALSE) AS is_short FROM stg"),
    "engagement_ratio": _with(
        "SELECT extraction_id, like_count, comment_count, view_count, "
        f"{_ratio('like_count', 'comment_count', 'view_count')} AS engagement_ratio FROM stg"),
    "upsert_core_sticky": _with("SELECT * FROM merged_sticky"),
    "upsert_core_refresh": _with("SELECT * FROM merged_refresh"),
    "history_append_sticky": _with("SELECT * FROM hist_new_sticky"),
    "history_append_refresh": _with("SELECT * FROM hist_new_refresh"),
    "history_today_count": _with(
        "SELECT (SELECT count(*) FROM merged_sticky) AS core_rows, "
        f"(SELECT count(*) FROM history_after WHERE CAST(recorded_at AS DATE) = {AS_OF_DATE}) AS history_today_rows"),
    "dq_row_count": _with("\nUNION ALL\n".join(
        _metric_sql(t, s, "row_count", None)
        for t, s in list(_PIPELINE_SOURCES.items()) + [("dq_docs", "dq_docs")])),
    "dq_missing": _metrics("dq_docs", "dq_docs", reg.DQ_MISSING),
    "dq_duplicates": _metrics("dq_docs", "dq_docs", reg.DQ_DUPLICATES),
    "dq_min_max": _metrics("dq_docs", "dq_docs", reg.DQ_MIN_MAX),
    "dq_max_length": _metrics("dq_docs", "dq_docs", reg.DQ_MAX_LENGTH),
    "dq_check_set": _check_set(),
    "dq_outcomes": _check_set(reg.OUTCOME_CHECKS, {"dq_docs": "dq_docs", "none": "(SELECT * FROM dq_docs WHERE n_chars < 0)"}),
    "snapshot_envelope_counts": _with(
        "SELECT channel_handle, extraction_date, CAST(count(*) AS INTEGER) AS total_videos, "
        "count(*) AS n_videos FROM stg GROUP BY channel_handle, extraction_date"),
    "envelope_roundtrip": _with(
        "SELECT channel_handle, extraction_date, CAST(count(*) OVER (PARTITION BY channel_handle, extraction_date) AS INTEGER) "
        "AS total_videos, title, duration, video_id, CAST(like_count AS VARCHAR) AS like_count, CAST(view_count AS VARCHAR) "
        "AS view_count, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, CAST(comment_count AS VARCHAR) "
        "AS comment_count, duration_readable FROM stg"),
}
