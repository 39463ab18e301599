"""Fixture views over the generated test tables (``<sf_dir>/<table>.parquet``).

Each view maps a test table onto one of the engine's inputs with integer arithmetic and
renames only, so an independent SQL engine can build the same rows (see
``clipstat.plans.oracle``).  The mappings:

* ``stg``       orders   -> staging rows (one order = one staged video row)
* ``pages``     lineitem -> playlist pages (one order = one page)
* ``details``   part     -> video items (parts with ``p_size % 10 = 0`` have none)
* ``items``     events   -> video items as JSON text
* ``channels``  nation x region -> channel listing; ``requests`` supplier x nation
* ``dq_docs``   documents left join labels
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.functions.durations import seconds_to_iso8601, seconds_to_readable
from clipstat.operators import core as core_ops
from clipstat.sources.tables import work_table
from clipstat.functions.columns import ntz

# Fixed values of the fixtures: run time of the upsert / history step, time of the
# previous run that produced ``core_before``, and the number of videos asked for.
AS_OF = dt.datetime(2002, 1, 2, 3, 4, 5)
PRIOR_RUN = dt.datetime(2001, 1, 1, 6, 0, 0)
MAX_RESULTS = 200
CHANNEL_RESULTS = 49
PLAYLISTS = 101


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _read(fx, spark, sf_dir, name):
    return fx.table(name) if fx is not None else table(spark, sf_dir, name)


def order_seconds(k) -> "F.Column":
    return F.when(k % 3 == 0, (k * 7919) % 5400).otherwise((k * 31) % 400)


def event_seconds(k) -> "F.Column":
    return (k * 7919) % 90000


def event_duration(k, secs) -> "F.Column":
    """Duration texts of events: most are whole, the rest are what a prefix match makes of
    fractions, days, units out of order, trailing text, and none at all."""
    case = k % 17
    return (F.when(case == 0, F.concat(F.lit("PT"), (k % 50).cast("string"), F.lit(".5S")))
             .when(case == 1, F.lit("P1DT2H"))
             .when(case == 2, F.concat(F.lit("PT"), (k % 50 + 1).cast("string"), F.lit("S2M")))
             .when(case == 3, F.lit(None).cast("string"))
             .when(case == 4, F.concat(F.lit("PT"), (k % 20 + 1).cast("string"), F.lit("H or so")))
             .otherwise(seconds_to_iso8601(secs)))


def stg(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Staging rows from orders.  Every count, the duration and the publication time are missing from
    some rows, some views are negative or fewer than the likes, and load times repeat (quarters), so that
    each rule about nulls, ties and failing checks meets rows that need it."""
    o = _read(fx, spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    o = o.withColumn("_secs", F.when(k % 37 != 5, order_seconds(k)))
    secs = F.col("_secs")
    quarter = F.make_timestamp_ntz(F.year("o_orderdate"), F.quarter("o_orderdate") * 3 - 2, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    views = (F.when(k % 29 == 2, F.lit(None)).when(k % 41 == 7, -(k % 7) - 1).when(k % 10 == 9, k % 50)
              .otherwise((k % 1000) * 100))
    return o.select(
        k.alias("extraction_id"),
        F.concat(F.lit("@"), F.col("o_orderstatus")).alias("channel_handle"),
        F.make_timestamp_ntz(F.year("o_orderdate"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
         .alias("extraction_date"),
        F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("video_id"),
        F.col("o_orderpriority").alias("title"),
        F.when(secs.isNotNull(), seconds_to_iso8601(secs)).alias("duration"),
        F.when(secs.isNotNull(), seconds_to_readable(secs)).alias("duration_readable"),
        F.when(k % 23 != 1, k % 77).alias("like_count"),
        views.alias("view_count"),
        F.when(k % 31 != 3, k % 13).alias("comment_count"),
        F.when(k % 43 != 8, F.col("o_orderdate")).alias("published_at"),
        quarter.alias("loaded_at"),
    )


def core_before(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Core table as left by the previous runs: the newest row of every video over all
    extractions before the newest one, but for the videos whose id ends in 7, which were
    removed from it and so are inserted anew."""
    rows = stg(spark, sf_dir, fx=fx)
    earlier = rows.where(F.col("extraction_date") < rows.agg(F.max("extraction_date")).scalar())
    earlier = earlier.where(~F.col("video_id").endswith("7"))
    return core_ops.core_projection(core_ops.dedupe_newest(earlier)).withColumn("updated_at", ntz(PRIOR_RUN))


def snapshot(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Merge source: latest extraction of all staged rows -> dedupe -> projection (the
    newest extraction date is a scalar subquery, executed inside the query)."""
    return core_ops.transform_latest(stg(spark, sf_dir, fx=fx))


def history_rows(snapshot_rows: DataFrame) -> DataFrame:
    """History as found: videos with even likes were recorded earlier today, videos whose
    likes divide by three on the day before (these do not keep today's row away)."""
    cols = ["video_id", "like_count", "view_count", "comment_count"]
    today = snapshot_rows.where(F.col("like_count") % 2 == 0).select(*cols, ntz(AS_OF).alias("recorded_at"))
    before = snapshot_rows.where(F.col("like_count") % 3 == 0).select(
        *cols, ntz(AS_OF - dt.timedelta(days=1)).alias("recorded_at"))
    return today.unionByName(before)


def pages(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Playlist pages ``(playlist_id, page_no, items, nextPageToken)``: one per order key,
    items in a fixed order.  Pages whose key leaves 13 modulo 97 have no items, pages whose
    key leaves 5 modulo 89 have no next-page token."""
    li = _read(fx, spark, sf_dir, "lineitem")
    # equal line numbers and parts give equal items, so further columns cannot change their order
    grouped = li.groupBy(F.col("l_orderkey").alias("page_no")).agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("_lines"))
    item = lambda x: F.struct(F.struct(F.struct(x["l_partkey"].cast("string").alias("videoId"))
                                       .alias("resourceId")).alias("snippet"))
    key = F.col("page_no")
    asked = F.transform("_lines", item)
    return grouped.select(
        F.concat(F.lit("U"), (key % PLAYLISTS).cast("string")).alias("playlist_id"),
        "page_no",
        F.when(key % 97 == 13, F.slice(asked, 1, 0)).otherwise(asked).alias("items"),
        F.when(key % 89 != 5, F.concat(F.lit("p"), (key + 1).cast("string"))).alias("nextPageToken"),
    )


def one_playlist(heads: DataFrame) -> DataFrame:
    """All pages' heads as one playlist that is not cut too early: only the largest key that leaves
    13 modulo 97 has no items (the others one), only the largest that leaves 5 modulo 89 has no token."""
    key = F.col("page_no")
    top = heads.agg(F.max(F.when(key % 97 == 13, key)), F.max(F.when(key % 89 == 5, key)))
    empty, last = (top.select(c).scalar() for c in top.columns)
    return heads.select(
        "page_no", F.when((key % 97 == 13) & (key != empty), 1).otherwise(F.col("n_ids")).alias("n_ids"),
        F.when((key % 89 == 5) & (key != last), F.lit("more")).otherwise(F.col("nextPageToken")).alias("nextPageToken"))


def detail_pages(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Detail responses ``(playlist_id, page_no, items)``: each part of an order once, largest
    key first, without those that have no details."""
    li = _read(fx, spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_no"), "l_partkey").distinct()
    found = _detailed_parts(fx, spark, sf_dir).select("p_partkey", "p_name", "p_size")
    # a part's few columns are shuffled, its item (four times as large) is made from them afterwards
    grouped = (li.join(found, F.col("l_partkey") == F.col("p_partkey"))
                 .groupBy("page_no").agg(F.collect_list(F.struct("p_partkey", "p_name", "p_size")).alias("_found")))
    items = F.transform(F.sort_array("_found", asc=False), lambda x: _video_item(x["p_partkey"], x["p_name"], x["p_size"]))
    return grouped.select(F.concat(F.lit("U"), (F.col("page_no") % PLAYLISTS).cast("string")).alias("playlist_id"),
                          "page_no", items.alias("items"))


def envelopes(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Snapshot envelopes as JSON text (column ``value``) built from orders: one for each
    channel, extraction and thousand order keys.  Publication times come with ``Z``, with an
    offset, with a fraction, or without a zone; keys may be absent (title, like_count, comment_count) or
    hold an explicit null (title, view_count)."""
    o = _read(fx, spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    base = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    published = (F.when(k % 4 == 0, F.concat(base, F.lit("Z"))).when(k % 4 == 1, F.concat(base, F.lit("+05:30")))
                  .when(k % 4 == 2, F.concat(base, F.lit(".123456Z"))).otherwise(base))
    always = F.lit(True)
    keys = [("title", F.when(k % 13 != 4, F.col("o_orderpriority")), k % 11 != 0), ("duration", F.lit("PT1M"), always),
            ("video_id", F.concat(F.lit("v"), F.col("o_custkey").cast("string")), always),
            ("like_count", (k % 77).cast("string"), k % 5 != 0),
            ("view_count", F.when(k % 17 != 6, (k % 1000).cast("string")), always), ("published_at", published, always),
            ("comment_count", (k % 13).cast("string"), k % 19 != 3), ("duration_readable", F.lit("1:00"), always)]
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value"), there.alias("there")) for n, v, there in keys]),
                       lambda e: e["there"])
    video = F.map_from_arrays(F.transform(entries, lambda e: e["key"]), F.transform(entries, lambda e: e["value"]))
    rows = o.select(F.concat(F.lit("@"), F.col("o_orderstatus")).alias("channel_handle"),
                    F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-01T00:00:00.5")).alias("extraction_date"),
                    F.floor(k / 1000).alias("_chunk"), video.alias("v"))
    grouped = rows.groupBy("channel_handle", "extraction_date", "_chunk").agg(F.collect_list("v").alias("videos"))
    return grouped.select(F.to_json(F.struct("channel_handle", "extraction_date", F.size("videos").alias("total_videos"), "videos"),
                                    {"ignoreNullFields": "true"}).alias("value"))


def _detailed_parts(fx, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(fx, spark, sf_dir, "part").where(F.col("p_size") % 10 != 0)


def _video_item(key, name, size) -> "F.Column":
    published = F.concat(F.lit("2020-01-"), F.lpad((size % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    return F.struct(
        key.cast("string").alias("id"),
        F.create_map(F.lit("title"), name, F.lit("publishedAt"), published).alias("snippet"),
        F.create_map(F.lit("viewCount"), (size * 1000).cast("string"), F.lit("likeCount"), size.cast("string"),
                     F.lit("commentCount"), (key % 17).cast("string")).alias("statistics"),
        F.create_map(F.lit("duration"), seconds_to_iso8601((key * 37) % 4000)).alias("contentDetails"),
    )


def details(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Videos-API items (``schemas.VIDEO_ITEM``) for parts whose size is not a multiple
    of ten; column ``item``."""
    p = _detailed_parts(fx, spark, sf_dir)
    return p.select(_video_item(F.col("p_partkey"), F.col("p_name"), F.col("p_size")).alias("item"))


def items(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Videos-API items as JSON text built from events; absent keys are left out:
    title when ``event_id % 11 = 0``, likeCount when ``% 5 = 0``, commentCount when
    ``% 7 = 0``."""
    e = _read(fx, spark, sf_dir, "events").withColumn("_secs", event_seconds(F.col("event_id")))
    k = F.col("event_id")
    doc = F.struct(
        F.concat(F.lit("v"), k.cast("string")).alias("id"),
        F.struct(F.when(k % 11 != 0, F.col("event_type")).alias("title"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt")).alias("snippet"),
        F.struct(F.when(k % 5 != 0, (k % 97).cast("string")).alias("likeCount"),
                 (k % 1000).cast("string").alias("viewCount"),
                 F.when(k % 7 != 0, (k % 13).cast("string")).alias("commentCount")).alias("statistics"),
        F.struct(event_duration(k, F.col("_secs")).alias("duration")).alias("contentDetails"),
    )
    return e.select(F.to_json(doc, {"ignoreNullFields": "true"}).alias("item"))


def channels(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Channel listing: handle ``@<n_name>``, id = nation key, uploads = region name."""
    n, r = _read(fx, spark, sf_dir, "nation"), _read(fx, spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("@"), F.col("n_name")).alias("handle"),
        F.col("n_nationkey").cast("string").alias("channel_id"),
        F.col("r_name").alias("uploads_playlist_id"))


def requests(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    """Handles to resolve: one per supplier, its nation's name behind one or two ``@``;
    every fifth asks for a channel that does not exist."""
    s, n = _read(fx, spark, sf_dir, "supplier"), _read(fx, spark, sf_dir, "nation")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("request_id"),
        F.concat(F.repeat(F.lit("@"), (F.col("s_suppkey") % 2 + 1).cast("int")), F.col("n_name"),
                 F.when(F.col("s_suppkey") % 5 == 0, "?").otherwise("")).alias("channel_handle"))


def dq_docs(spark: SparkSession, sf_dir: str, fx: "Fixtures | None" = None) -> DataFrame:
    d, lab = _read(fx, spark, sf_dir, "documents"), _read(fx, spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


class Fixtures:
    """The fixture views of one ``sf_dir`` for one composed query.  Table reads are shared;
    a staged view is computed once, written to a work table and read by all its consumers."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[tuple, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def view(self, key: tuple, build, staged: bool = False) -> DataFrame:
        if key not in self._views:
            df = build()
            self._views[key] = work_table(df, str(key[0])) if staged else df
        return self._views[key]
