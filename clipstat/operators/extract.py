"""Extraction over landed API pages: playlist ids, page stop, detail join, first n,
flattening of video items, channel resolution and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions.columns import strip_handle
from clipstat.functions.durations import iso8601_to_seconds, seconds_to_readable

# The API's page size and the default number of videos per run.
PAGE_SIZE = 50
DEFAULT_MAX_RESULTS = 200


def playlist_video_ids(pages: DataFrame) -> DataFrame:
    """Playlist pages ``(page_no, items, nextPageToken)`` -> ``(page_no, pos, video_id)``.

    ``pos`` is the 0-based position in the page.  A page with no items yields no rows.
    """
    return pages.select("page_no", F.posexplode("items").alias("pos", "item")) \
                .select("page_no", "pos", F.col("item.snippet.resourceId.videoId").alias("video_id"))


MAX_PAGE = (1 << 63) - 1


def page_heads(pages: DataFrame, by=()) -> DataFrame:
    """What the crawl needs of a page: ``(*by, page_no, n_ids, nextPageToken)``.  Staged once it spares
    :func:`crawled_pages`, which looks at the pages twice, from parsing them twice."""
    return pages.select(*by, "page_no", F.coalesce(F.size("items"), F.lit(0)).alias("n_ids"), "nextPageToken")


def _stop_bound(columns) -> Column:
    """Aggregate: the last page the crawl reads, NULL when no page stops it.

    The crawl stops *before* the first page with no ids and *after* the first page
    without ``nextPageToken`` (integer page numbers, so "before e" is "at most e - 1").
    """
    empty = (F.col("n_ids") if "n_ids" in columns else F.coalesce(F.size("items"), F.lit(0))) == 0
    no_token = F.col("nextPageToken").isNull() | (F.col("nextPageToken") == "")
    return F.least(F.min(F.when(empty, F.col("page_no") - 1)),
                   F.min(F.when(~empty & no_token, F.col("page_no"))))


def crawled_pages(pages: DataFrame, by=None) -> DataFrame:
    """Pages (or their :func:`page_heads`) that the crawl reads, following the paging loop: stop before
    the first page with no ids and after the first page without a next-page token.

    ``by`` (e.g. ``["playlist_id"]``) crawls many playlists at once: the bound is one
    aggregate row per playlist, joined back on the key (small, so AQE broadcasts it).
    """
    if not by:
        bound = pages.agg(_stop_bound(pages.columns)).scalar()
        return pages.where(F.col("page_no") <= F.coalesce(bound, F.lit(MAX_PAGE)))
    by = list(by)
    bounds = pages.groupBy(*by).agg(_stop_bound(pages.columns).alias("_last"))
    return (pages.join(bounds, by, "inner")
                 .where(F.col("page_no") <= F.coalesce(F.col("_last"), F.lit(MAX_PAGE))).drop("_last"))


def flatten_video_items(items: DataFrame, item_col: str = "item") -> DataFrame:
    """Video items (``schemas.VIDEO_ITEM`` struct, or JSON text) -> the 8 text fields.

    Defaults follow the reference: missing title ``""`` (a present null stays null);
    missing counts ``"0"`` and a present null count ``"None"``; missing duration and
    publishedAt stay null; duration_readable is derived from the duration.
    """
    from clipstat import schemas

    col = F.col(item_col)
    if dict(items.dtypes)[item_col] == "string":
        col = F.from_json(col, schemas.VIDEO_ITEM)
    rows = items.withColumn("_it", col)
    snippet, stats, details = F.col("_it.snippet"), F.col("_it.statistics"), F.col("_it.contentDetails")

    def get(m: Column, key: str, missing: Column, null: Column | None = None) -> Column:
        present = F.coalesce(F.map_contains_key(m, key), F.lit(False))
        value = m[key]
        if null is not None:
            value = F.coalesce(value, null)
        return F.when(present, value).otherwise(missing)

    zero, none = F.lit("0"), F.lit("None")
    keep = [c for c in items.columns if c != item_col]
    # Staged projections: each field is extracted once, then the duration is parsed
    # once and formatted from the parsed seconds (Catalyst keeps the stages apart
    # rather than duplicate the regex work).
    fields = rows.select(
        *keep,
        F.when(snippet.isNull(), F.raise_error(F.lit("video item without snippet")).cast("string"))
         .otherwise(get(snippet, "title", F.lit(""))).alias("title"),
        get(details, "duration", F.lit(None).cast("string")).alias("duration"),
        F.col("_it.id").alias("video_id"),
        get(stats, "likeCount", zero, none).alias("like_count"),
        get(stats, "viewCount", zero, none).alias("view_count"),
        get(snippet, "publishedAt", F.lit(None).cast("string")).alias("published_at"),
        get(stats, "commentCount", zero, none).alias("comment_count"),
    )
    secs = fields.withColumn("_secs", iso8601_to_seconds("duration"))
    return secs.withColumn("duration_readable", seconds_to_readable("_secs")).drop("_secs")


def videos_page_items(pages: DataFrame) -> DataFrame:
    """Videos pages ``(page_no?, items)`` -> one row per item (column ``item``)."""
    keep = [c for c in pages.columns if c != "items"]
    return pages.select(*keep, F.explode("items").alias("item"))


def page_videos(pages: DataFrame, detail_pages: DataFrame, by=()) -> DataFrame:
    """Videos of the crawled ``pages``: the items of each page's detail response, flattened,
    with ``page_no`` and their position ``pos`` *in the response* (and the key columns ``by``).

    As the crawl appends response items as they come, order and multiplicity follow the
    response and not the id list: an id without an item vanishes, an id asked twice and
    answered once counts once.  Only the keys of the crawled pages are joined; a response
    is never matched row by row.  Where these keys are staged and few, Spark broadcasts them and takes
    the join below whatever builds the responses, so responses outside the crawl are not shuffled.
    An item without ``id`` fails the query.
    """
    keys = [*by, "page_no"]
    answered = detail_pages.join(pages.select(*keys), keys, "left_semi")
    items = answered.select(*keys, F.posexplode("items").alias("pos", "item"))
    flat = flatten_video_items(items)
    return flat.withColumn("video_id", F.when(
        F.col("video_id").isNull(), F.raise_error(F.lit("video item without id")).cast("string"))
        .otherwise(F.col("video_id")))


def _rank_in(videos: DataFrame, by) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("page_no", "pos")
    return videos.withColumn("_rank", F.row_number().over(w))


def _first_pages(videos: DataFrame, n: int, by) -> DataFrame:
    """Pages of every playlist before which it has fewer than ``n`` videos, with their number ``_k``: one row a
    page, counted before the shuffle."""
    per_page = videos.groupBy(*by, "page_no").agg(F.count(F.lit(1)).alias("_k"))
    w = Window.partitionBy(*by).orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_k").over(w), F.lit(0))
    return per_page.withColumn("_before", before).where(F.col("_before") < n).drop("_before")


def first_n(videos: DataFrame, n: int | None = DEFAULT_MAX_RESULTS, by=None) -> DataFrame:
    """First ``n`` videos in paging order (``TakeOrderedAndProject``: a bounded top-n);
    ``None`` keeps all.

    With ``by`` the first ``n`` of every playlist: ``row_number() <= n`` is planned as a
    partial ``WindowGroupLimit`` before the shuffle, so a channel holding a third of all
    rows still sends at most ``n`` rows per map task.  Spark plans it up to a session
    threshold only; beyond it the pages that hold the first ``n`` are told first, and the
    shuffle moves their videos.
    """
    if n is None:
        return videos
    if not by:
        return videos.orderBy("page_no", "pos").limit(n)
    by = list(by)
    if n > int(videos.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        videos = videos.join(_first_pages(videos, n, by).drop("_k"), [*by, "page_no"], "left_semi")
    return _rank_in(videos, by).where(F.col("_rank") <= n).drop("_rank")


def _summary_row(n: int | None, *keys) -> list:
    fetched = F.col("videos_fetched")
    returned = fetched if n is None else F.least(fetched, F.lit(n).cast("bigint"))
    return [*keys, "videos_fetched", returned.alias("videos_returned"),
            (F.floor(fetched / PAGE_SIZE) * 2).cast("bigint").alias("quota_units")]


def extraction_summary(videos: DataFrame, n: int | None = DEFAULT_MAX_RESULTS, by=None) -> DataFrame:
    """One row (with ``by``: one per playlist): videos fetched (whole pages until at least
    ``n``), videos returned and the estimated quota ``(fetched // 50) * 2``.

    Works on one row per page: a page is fetched while the pages before it hold fewer than
    ``n`` videos.  One playlist has its running count through a bounded top-n of pages; many
    have it through a window per playlist over pages that were counted before the shuffle.
    """
    by = list(by or ())
    if n is None:
        counted = videos.groupBy(*by).agg(F.count(F.lit(1)).alias("videos_fetched"))
        return counted.select(*_summary_row(n, *by))
    if by:
        pages = _first_pages(videos, n, by)
    else:
        # at least one video a page, so the first n pages always suffice
        first = videos.groupBy("page_no").agg(F.count(F.lit(1)).alias("_k")).orderBy("page_no").limit(n)
        w = Window.orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
        pages = first.withColumn("_before", F.coalesce(F.sum("_k").over(w), F.lit(0))).where(F.col("_before") < n)
    fetched = pages.groupBy(*by).agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("videos_fetched"))
    return fetched.select(*_summary_row(n, *by))


def resolve_channels(requests: DataFrame, channels: DataFrame, strict: bool = False) -> DataFrame:
    """Resolve handles to channel id and uploads playlist.

    ``requests`` has ``channel_handle``; ``channels`` is the landed channel listing with
    ``handle``, ``channel_id`` and ``uploads_playlist_id``.  All leading ``@`` are stripped
    on both sides for matching; the stored handle keeps its ``@``.  Of several listings that
    strip to one name the first counts (by landed name), so a request gives one row.  Unresolved handles
    give NULL ids.  With ``strict`` reading either id of an unknown handle, or the playlist
    of a channel without uploads, fails the query (each id carries its own check, so column
    pruning cannot remove it).
    """
    listing = channels.groupBy(strip_handle("handle").alias("_name")).agg(
        F.min(F.struct("handle", "channel_id", "uploads_playlist_id")).alias("_first")).select(
        "_name", "_first.channel_id", "_first.uploads_playlist_id")
    joined = requests.withColumn("_name", strip_handle("channel_handle")) \
                     .join(listing, "_name", "left").drop("_name")
    if strict:
        def fail(text):
            return F.raise_error(F.concat(F.lit(text), F.col("channel_handle"))).cast("string")

        channel, uploads = F.col("channel_id"), F.col("uploads_playlist_id")
        joined = joined.withColumns({
            "channel_id": F.when(channel.isNull(), fail("no channel for handle ")).otherwise(channel),
            "uploads_playlist_id": F.when(channel.isNull(), fail("no channel for handle "))
                                    .when(uploads.isNull(), fail("no uploads playlist for handle ")).otherwise(uploads)})
    return joined


def require_resolved(resolved: DataFrame) -> None:
    """Raise for unknown handles and for channels without an uploads playlist; names the
    first few (a bounded look, whatever the number of handles)."""
    bad = resolved.where("channel_id IS NULL OR uploads_playlist_id IS NULL") \
                  .select("channel_handle", "channel_id").orderBy("channel_handle").limit(5).collect()
    if bad:
        raise ValueError("; ".join(
            (f"no channel for handle {r.channel_handle}" if r.channel_id is None
             else f"no uploads playlist for handle {r.channel_handle}") for r in bad))
