"""End-to-end pipelines composed from the operators.

* :func:`extract_to_snapshot` - landed API pages -> snapshot envelope (PIPE-1)
* :func:`run_update` - newest snapshot -> staging -> core -> history (PIPE-2)
* :func:`run_quality` - checks over the three tables, then the gate (PIPE-3)

Every step reads its inputs from storage and writes its output before the next step
reads it back, so a lost executor only recomputes the current step and lineage never
spans the whole run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.operators import core as core_ops
from clipstat.operators import extract, history, quality
from clipstat.operators.staging import explode_envelope
from clipstat.sinks import tables as table_sink
from clipstat.sinks.envelope import (DEFAULT_PAGES_PER_CHUNK, build_envelopes, publish_envelopes,
                                     snapshot_name, write_snapshot)
from clipstat.sources import landed, snapshots, state
from clipstat.sources.tables import TableStore, drop_work, work_table
from clipstat.functions.columns import ntz




def _audit(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.AUDIT)


@dataclass
class LandedLayout:
    """Where landed API responses live::

        <root>/channels/<handle>.json
        <root>/playlists/playlist_id=<id>/page_<n>.json
        <root>/videos/playlist_id=<id>/page_<n>.json   (details answering playlist page n)
    """
    root: str

    def channels(self) -> str:
        return f"{self.root}/channels"

    def playlist(self, playlist_id: str) -> str:
        return f"{self.playlists()}/{landed.PLAYLIST}={playlist_id}"

    def videos(self, playlist_id: str) -> str:
        return f"{self.all_videos()}/{landed.PLAYLIST}={playlist_id}"

    def playlists(self) -> str:
        return f"{self.root}/playlists"

    def all_videos(self) -> str:
        return f"{self.root}/videos"


def _resolved(spark: SparkSession, layout: LandedLayout, handles: DataFrame, made: list[str]) -> DataFrame:
    """``channel_handle, playlist_id`` of every handle asked for (once each); an unknown handle
    or a channel without uploads is an error."""
    asked = handles.select("channel_handle").distinct()
    found = work_table(extract.resolve_channels(asked, landed.read_channel_listing(spark, layout.channels())), "resolved", made)
    extract.require_resolved(found)
    return found.select("channel_handle", F.col("uploads_playlist_id").alias("playlist_id"))


def _crawled_videos(pages: DataFrame, detail_pages: DataFrame, made: list[str], by=()) -> DataFrame:
    """Videos of the crawled pages as a work table; the pages are parsed once.  Of many playlists the keys
    of the crawled pages are staged too: their size decides how the responses are joined."""
    heads = work_table(extract.page_heads(pages, by), "heads", made)
    if by:
        crawl = work_table(extract.crawled_pages(heads, list(by)).select(*by, "page_no"), "crawl", made)
    else:
        crawl = extract.crawled_pages(heads)
    return work_table(extract.page_videos(crawl, detail_pages, by), "videos", made)


def channel_videos(spark: SparkSession, layout: LandedLayout, channel_handle: str,
                   max_results: int | None = extract.DEFAULT_MAX_RESULTS, made: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolve the channel, crawl its uploads playlist, take the detail responses of the
    crawled pages in their order, keep the first ``max_results`` (``None``: all).  Returns
    ``(videos, summary)``; the landed pages are read once for both.  The work tables behind both
    are added to ``made`` for the caller to remove."""
    made = [] if made is None else made
    request = spark.createDataFrame([(channel_handle,)], "channel_handle string")
    playlist_id = _resolved(spark, layout, request, made).first()["playlist_id"]
    videos = _crawled_videos(landed.read_playlist_pages(spark, layout.playlist(playlist_id)),
                             landed.read_videos_pages(spark, layout.videos(playlist_id)), made)
    return extract.first_n(videos, max_results), extract.extraction_summary(videos, max_results)


def extract_to_snapshot(spark: SparkSession, landed_root: str, out_dir: str, channel_handle: str,
                        max_results: int | None = extract.DEFAULT_MAX_RESULTS,
                        extraction_date: dt.datetime | None = None) -> tuple[str, DataFrame]:
    """PIPE-1: extract and save one snapshot; returns ``(path, audit)``."""
    at = extraction_date or dt.datetime.now()
    made: list[str] = []
    try:
        videos, summary = channel_videos(spark, LandedLayout(landed_root), channel_handle, max_results, made)
        path = write_snapshot(videos, out_dir, channel_handle, at)
        s = summary.first()
    finally:
        drop_work(spark, made)
    audit = _audit(spark, [
        ("extracted", s["videos_fetched"], f"quota~{s['quota_units']}", at),
        ("saved", s["videos_returned"], path, at),
    ])
    return path, audit


def extract_channels_to_snapshot(spark: SparkSession, landed_root: str, out_dir: str, handles: DataFrame,
                                 max_results: int | None, extraction_date: dt.datetime | None = None,
                                 pages_per_chunk: int = DEFAULT_PAGES_PER_CHUNK) -> tuple[str, DataFrame]:
    """PIPE-1 for many channels in one job.

    ``handles`` is a DataFrame with ``channel_handle``.  An unknown handle or a channel
    without uploads fails the job before anything is read.  The landed pages of the playlists
    asked for are read in one scan of their folders; the crawl stop, first ``max_results`` (``None``: all) and summary run
    per playlist, and handles that name the same channel each get its videos.  The result is
    one snapshot folder holding every channel's envelopes (chunked), which :func:`run_update`
    loads like any other snapshot.  Returns ``(path, summary)`` with one summary row per
    handle (a work table); a channel without landed pages or videos has zeros.
    """
    at = extraction_date or dt.datetime.now()
    layout, by, made = LandedLayout(landed_root), [landed.PLAYLIST], []
    try:
        wanted = _resolved(spark, layout, handles, made)
        videos = _crawled_videos(landed.read_playlists(spark, layout.playlists(), wanted),
                                 landed.read_videos(spark, layout.all_videos(), wanted), made, by)
        counted = extract.extraction_summary(videos, max_results, by)
        summary = work_table(wanted.join(counted, by, "left").na.fill(0, ["videos_fetched", "videos_returned", "quota_units"]), "summary")
        kept = extract.first_n(videos, max_results, by).join(wanted, by)
        tagged = kept.withColumn("extraction_date", ntz(at))
        envelopes = build_envelopes(tagged, ["page_no", "pos"], F.floor(F.col("page_no") / pages_per_chunk))
        path = publish_envelopes(spark, envelopes, f"{out_dir.rstrip('/')}/{snapshot_name(at)}")
    finally:
        drop_work(spark, made)
    return path, summary


def run_update(spark: SparkSession, data_dir: str, store: TableStore, as_of: dt.datetime | None = None,
               refresh=(), per: str | None = None, strict: bool = False) -> DataFrame:
    """PIPE-2: newest snapshot -> staging append -> transform + upsert -> history.

    Returns the audit rows.  ``refresh=("extraction_date",)`` gives a real daily history
    (the default reproduces the reference, where an updated video keeps its first
    extraction date and so gets no further history rows).
    """
    as_of = as_of or dt.datetime.now()
    path = snapshots.latest_snapshot_path(spark, data_dir)
    loaded = load_staging(store, snapshots.read_envelopes(spark, path), as_of, strict)
    version = transform(store, as_of, refresh, per)
    return _audit(spark, update_audit(store, loaded, path, version, as_of))


def update_audit(store: TableStore, loaded: int, source: str, version: int, as_of: dt.datetime) -> list[tuple]:
    """Audit rows of one update; core is counted by its manifest."""
    core_rows = sum(z["rows"] for z in store.manifest(version)["zones"].values())
    return [
        ("staged", loaded, source, as_of),
        ("core", core_rows, f"version {version}", as_of),
        ("history_today", history.history_rows_today(store.read_day("history", as_of.date()), as_of).count(), None, as_of),
    ]


def load_staging(store: TableStore, envelopes: DataFrame, as_of: dt.datetime, strict: bool = False,
                 token: str | None = None) -> int:
    """Append the videos of raw envelopes to staging in one atomic step; returns their number.  A ``token``
    that staging holds already is not loaded again."""
    return table_sink.append(store, "staging", explode_envelope(envelopes, loaded_at=as_of, strict=strict),
                             id_col="extraction_id", token=token)


def transform(store: TableStore, as_of: dt.datetime, refresh=(), per: str | None = None,
              newest: dt.datetime | None = None, only_new: bool = False) -> int:
    """Newest staged extraction (or ``newest``) -> core -> history; returns core's version.
    With ``only_new`` videos that core has already are left as they are.

    Reads the days of staging that hold what is transformed (with ``per`` those that the kept newest
    extraction of each channel names) and the buckets of core that the videos fall into; history looks at
    the buckets whose zones reach the newest extraction."""
    if per is not None:
        if per != "channel_handle":
            raise ValueError(f"the newest extraction is kept per channel_handle, not {per!r}")
        dates = sorted(r["newest"] for r in state.newest_per_channel(store).select("newest").distinct().collect())
        staging = store.read_days("staging", {d.date() for d in dates})
        span = (dates[0], dates[-1]) if dates else None
    else:
        staging = store.read_day("staging", newest.date()) if newest is not None else store.read_latest_day("staging")
        newest = newest or core_ops.newest_extraction(staging)
        span = (newest, newest) if newest is not None else None
    rows = core_ops.transform_latest(staging, per, newest if per is None else None)
    made: list[str] = []
    try:
        source = store.stage("snapshot", rows, made)
        table_sink.assert_unique(source, "video_id", "upsert source")
        if only_new:
            manifest = store.manifest()
            there = store.read_core(manifest, set(table_sink.touched_buckets(store, source, manifest)))
            source = store.stage("new", source.join(there.select("video_id"), "video_id", "left_anti"), made)
        version = table_sink.upsert_core(store, source, as_of, refresh)
        today = store.read_day("history", as_of.date())
        core = store.core_where(extraction_date=span) if span else store.read("core")
        new_rows = history.new_history_rows(core, staging, today, as_of, newest=newest, per=per)
        table_sink.append(store, "history", new_rows, id_col="history_id")
    finally:
        drop_work(store.spark, made)
    return version


def run_quality(spark: SparkSession, store: TableStore, checks=None, gate: bool = True,
                scope: str = "all") -> DataFrame:
    """PIPE-3: evaluate the checks on staging, core and history; raise unless all pass.

    ``scope="all"`` checks whole tables, as the reference does.  ``scope="incremental"`` gives the same
    rows from metrics kept for every load and every bucket of core: a run reads what is new since the
    last one, and gates as well.  ``scope="latest"``
    checks only the newest day of the two append-only tables (whose older days were
    checked when they were written) and the whole core table, so the cost of a run stops
    growing with the retained history; it is a report and never gates.
    """
    checks = checks or quality.DEFAULT_CHECKS
    if scope == "incremental":
        results = quality.run_checks(dict.fromkeys(("staging", "core", "history")), checks,
                                     lambda table, metrics: state.incremental_metrics(store, table, metrics))
        return quality.gate(results) if gate else results
    if scope == "all":
        tables = {name: store.read(name) for name in ("staging", "core", "history")}
    elif scope == "latest":
        tables = {"staging": store.read_latest_day("staging"), "core": store.read("core"),
                  "history": store.read_latest_day("history")}
    else:
        raise ValueError(f"unknown scope {scope!r}")
    results = quality.run_checks(tables, checks)
    return quality.gate(results) if gate and scope == "all" else results
