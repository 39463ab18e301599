"""Store, end-to-end pipelines and the streaming ingest on temporary folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from clipstat.plans import pipelines
from clipstat.sinks import tables as table_sink
from clipstat.sources.tables import TableStore
from clipstat.streaming.ingest import start_ingest

from tests.test_extract import land_channel

DAY1 = dt.datetime(2025, 10, 1, 8, 0, 0)
DAY2 = dt.datetime(2025, 10, 2, 8, 0, 0)


def api_video(vid, views, minutes):
    return {"id": vid, "snippet": {"title": f"Video {vid}", "publishedAt": "2025-09-01T10:00:00Z"},
            "statistics": {"viewCount": str(views), "likeCount": str(views // 10), "commentCount": "1"},
            "contentDetails": {"duration": f"PT{minutes}M"}}


def land(root, views):
    land_channel(root, handle="MrChannel", playlist="UU_X",
                 pages={1: (["a", "b"], "p2"), 2: (["c", "gone"], None)},
                 videos={1: [api_video("a", views, 1), api_video("b", views, 3)],
                         2: [api_video("c", views, 90)]})


def test_store_versions_skip_uncommitted(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    assert store.read("core").count() == 0
    os.makedirs(store.version_path(1))                       # a publish that died midway
    assert store.versions() == [] and store.next_folder() == 2
    from clipstat.plans import fixtures as fx
    core = fx.core_before(spark, "/root/testdata/sf0.001")
    assert table_sink.publish(store, core) == 1
    assert store.versions() == [1] and store.manifest()["wrote"] == 2 and store.read("core").count() == core.count()


def test_end_to_end(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    path, audit = pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", max_results=200,
                                                extraction_date=DAY1)
    assert {r.stage: r.rows for r in audit.collect()} == {"extracted": 3, "saved": 3}

    a1 = {r.stage: r.rows for r in pipelines.run_update(spark, data, store, DAY1).collect()}
    assert a1 == {"staged": 3, "core": 3, "history_today": 3}
    core = {r.video_id: r for r in store.read("core").collect()}
    assert core["c"].duration_seconds == 5400 and core["c"].content_type == "Long"
    assert core["a"].is_short and core["b"].content_type == "Medium"

    # same snapshot, same day again: staging grows, core and history do not
    a2 = {r.stage: r.rows for r in pipelines.run_update(spark, data, store, DAY1).collect()}
    assert a2["core"] == 3 and a2["history_today"] == 3
    assert store.read("staging").count() == 6 and store.read("history").count() == 3

    # a new snapshot the next day: counts updated, extraction_date sticky -> no history
    land(landed, 5000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY2)
    pipelines.run_update(spark, data, store, DAY2)
    core2 = {r.video_id: r for r in store.read("core").collect()}
    assert core2["a"].view_count == 5000 and core2["a"].extraction_date == DAY1
    assert store.read("history").count() == 3

    res = pipelines.run_quality(spark, store)
    assert res.count() == 26 and {r.outcome for r in res.collect()} == {"pass"}


def test_refresh_mode_gives_daily_history(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY1)
    pipelines.run_update(spark, data, store, DAY1, refresh=("extraction_date",))
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY2)
    pipelines.run_update(spark, data, store, DAY2, refresh=("extraction_date",))
    hist = store.read("history")
    assert hist.count() == 6
    assert hist.select("history_id").distinct().count() == 6


def test_quality_gate_fails_on_empty_history(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    with pytest.raises(Exception):
        pipelines.run_quality(spark, store)


def test_streaming_ingest(spark, tmp_dir):
    data, store = f"{tmp_dir}/incoming", TableStore(spark, f"{tmp_dir}/tables")
    os.makedirs(data)
    for day, views in ((1, 10), (2, 20)):
        payload = {"channel_handle": "@c", "extraction_date": f"2025-10-0{day}T08:00:00", "total_videos": 2,
                   "videos": [{"title": "x", "duration": "PT1M", "video_id": v, "like_count": "1",
                               "view_count": str(views), "published_at": "2025-09-01T00:00:00Z",
                               "comment_count": "0", "duration_readable": "1:00"} for v in ("a", "b")]}
        with open(f"{data}/youtube_videos_2025100{day}_080000.json", "w") as f:
            json.dump(payload, f, indent=2)
    clock = iter([DAY1, DAY2, DAY2, DAY2])
    start_ingest(spark, data, store, clock=lambda: next(clock)).awaitTermination(120)
    assert store.read("staging").count() == 4
    assert {r.video_id: r.view_count for r in store.read("core").collect()} == {"a": 20, "b": 20}
    assert len(store.versions()) == 2


def test_ids_grow_with_appends_and_survive_lost_reservations(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY1)
    seen = set()
    for run in range(3):
        pipelines.run_update(spark, data, store, DAY1)
        ids = {r.extraction_id for r in store.read("staging").collect()}
        assert len(ids) == 3 * (run + 1) and min(ids - seen) > max(seen, default=0)
        seen = ids
        if run == 1:  # reservations lost: ids go on after the table's own maximum
            for name in os.listdir(f"{tmp_dir}/tables/_seq/staging"):
                os.remove(f"{tmp_dir}/tables/_seq/staging/{name}")


def test_reservations_are_exclusive(spark, tmp_dir):
    store, other = TableStore(spark, tmp_dir), TableStore(spark, tmp_dir)
    got = [s.reserve_ids("staging", "extraction_id") for s in (store, other) * 8]
    assert got == sorted(set(got)) and len(os.listdir(f"{tmp_dir}/_seq/staging")) < 30


def test_audit_counts_the_rows_of_this_load(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY2)
    counts = [{r.stage: r.rows for r in pipelines.run_update(spark, data, store, DAY2).collect()}["staged"] for _ in range(2)]
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", max_results=1, extraction_date=DAY1)
    os.rename(f"{data}/youtube_videos_20251001_080000.json", f"{data}/zzz.json")  # older, but chosen by name
    counts.append({r.stage: r.rows for r in pipelines.run_update(spark, data, store, DAY2).collect()}["staged"])
    assert counts == [3, 3, 1]


def test_repeated_keys_in_the_upsert_source_fail(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "video_id string")
    with pytest.raises(ValueError, match="not unique"):
        table_sink.assert_unique(df, "video_id", "upsert source")
    table_sink.assert_unique(df.distinct(), "video_id", "upsert source")


def test_latest_day_read_is_pruned(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY1)
    pipelines.run_update(spark, data, store, DAY1)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY2)
    pipelines.run_update(spark, data, store, DAY2)
    assert store.days("staging") == ["2025-10-01", "2025-10-02"]
    recent = store.read_latest_day("staging")
    files = recent.inputFiles()
    # only the newest day's folder is listed and scanned
    assert files and all("extraction_day=2025-10-02" in f for f in files)
    assert recent.count() == 3


def core_files(store):
    return {(b, v): sorted(f for f in os.listdir(store.bucket_folder(b, v)) if f.endswith(".parquet"))
            for b, v in store.manifest()["at"].items()}


def test_publish_rewrites_touched_buckets_only(spark, tmp_dir):
    from clipstat.plans import fixtures as fx

    store = TableStore(spark, tmp_dir, core_buckets=8, keep_versions=2)
    core = fx.core_before(spark, "/root/testdata/sf0.001")
    table_sink.publish(store, core)
    whole = {r.video_id: r for r in store.read("core").collect()}
    before = core_files(store)
    assert len(before) == 8 and all(len(f) == 1 for f in before.values())
    victim = sorted(whole)[0]
    source = core.where(F.col("video_id") == victim).withColumn("title", F.lit("changed")).drop("updated_at")
    for run in range(10):
        assert table_sink.upsert_core(store, source, DAY1) == run + 2
        after = core_files(store)
        assert len(after) == 8 and all(len(f) == 1 for f in after.values())     # the file count stays
        assert len(set(before) - set(after)) == 1                               # one bucket moved
    now = {r.video_id: r for r in store.read("core").collect()}
    assert set(now) == set(whole) and now[victim].title == "changed"
    assert all(now[v] == whole[v] for v in whole if v != victim)
    assert store.versions() == [10, 11]                                         # retention
    folders = [f for f in os.listdir(f"{tmp_dir}/core") if f.startswith("v=")]
    assert len(folders) <= 4                                                    # the first, and the kept ones


@pytest.mark.parametrize("buckets", [1, 8])
def test_core_does_not_depend_on_buckets(spark, tmp_dir, buckets):
    landed, data = f"{tmp_dir}/landed", f"{tmp_dir}/data"
    store = TableStore(spark, f"{tmp_dir}/tables", buckets)
    for day, views in ((DAY1, 1000), (DAY2, 7000)):
        land(landed, views)
        pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=day)
        pipelines.run_update(spark, data, store, day)
    got = {r.video_id: (r.view_count, r.extraction_date, r.updated_at) for r in store.read("core").collect()}
    assert got == {v: (7000, DAY1, DAY2) for v in "abc"}
    assert TableStore(spark, f"{tmp_dir}/tables", 3).manifest()["buckets"] == buckets  # the table keeps its number


def test_quality_scope_latest(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 1000)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY1)
    pipelines.run_update(spark, data, store, DAY1)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY2)
    pipelines.run_update(spark, data, store, DAY2, refresh=("extraction_date",))
    res = {(r.table_name, r.metric, r.column_name): r.value
           for r in pipelines.run_quality(spark, store, scope="latest").collect()}
    assert res[("staging", "row_count", None)] == 3 and res[("history", "row_count", None)] == 3
    assert store.read_day("history", "2025-10-02").count() == 3
    assert store.read_day("history", "1999-01-01").count() == 0


def test_streaming_ingest_resumes_from_checkpoint(spark, tmp_dir):
    data, store, ckpt = f"{tmp_dir}/incoming", TableStore(spark, f"{tmp_dir}/tables"), f"{tmp_dir}/ckpt"
    os.makedirs(data)

    def drop(day, views):
        payload = {"channel_handle": "@c", "extraction_date": f"2025-10-0{day}T08:00:00", "total_videos": 1,
                   "videos": [{"title": "x", "duration": "PT2M", "video_id": "a", "like_count": "1",
                               "view_count": str(views), "published_at": "2025-09-01T00:00:00Z",
                               "comment_count": "0", "duration_readable": "2:00"}]}
        with open(f"{data}/youtube_videos_2025100{day}_080000.json", "w") as f:
            json.dump(payload, f)

    drop(1, 10)
    start_ingest(spark, data, store, checkpoint_location=ckpt, clock=lambda: DAY1).awaitTermination(120)
    assert store.read("staging").count() == 1
    # restart with the same checkpoint: only the new file is read
    drop(2, 20)
    start_ingest(spark, data, store, checkpoint_location=ckpt, clock=lambda: DAY2).awaitTermination(120)
    assert store.read("staging").count() == 2
    assert store.read("core").first().view_count == 20
    assert store.read("staging").select("extraction_id").distinct().count() == 2


def test_many_channels_in_one_job(spark, tmp_dir):
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    for ch, pl, views in (("One", "UU_1", 10), ("Two", "UU_2", 20), ("Three", "UU_3", 30)):
        write_channel = {"items": [{"id": f"UC_{ch}", "contentDetails": {"relatedPlaylists": {"uploads": pl}}}]}
        os.makedirs(f"{landed}/channels", exist_ok=True)
        with open(f"{landed}/channels/{ch}.json", "w") as f:
            json.dump(write_channel, f)
        vids = [f"{ch}_{i}" for i in range(4)]
        for n, chunk in enumerate((vids[:2], vids[2:]), start=1):
            page = {"items": [{"snippet": {"resourceId": {"videoId": v}}} for v in chunk]}
            if n == 1:
                page["nextPageToken"] = "next"
            os.makedirs(f"{landed}/playlists/playlist_id={pl}", exist_ok=True)
            os.makedirs(f"{landed}/videos/playlist_id={pl}", exist_ok=True)
            with open(f"{landed}/playlists/playlist_id={pl}/page_{n:05d}.json", "w") as f:
                json.dump(page, f)
            with open(f"{landed}/videos/playlist_id={pl}/page_{n:05d}.json", "w") as f:
                json.dump({"items": [api_video(v, views, 2) for v in chunk]}, f)
    handles = spark.createDataFrame([("@One",), ("@@Two",), ("@Three",)], "channel_handle string")
    path, summary = pipelines.extract_channels_to_snapshot(spark, landed, data, handles, max_results=3,
                                                           extraction_date=DAY1)
    got = {r.channel_handle: (r.videos_fetched, r.videos_returned) for r in summary.collect()}
    assert got == {"@One": (4, 3), "@@Two": (4, 3), "@Three": (4, 3)}
    pipelines.run_update(spark, data, store, DAY1)
    core = store.read("core")
    assert core.count() == 9
    assert {r.channel_handle: r.n for r in core.groupBy("channel_handle").agg(F.count("*").alias("n")).collect()} \
        == {"@One": 3, "@@Two": 3, "@Three": 3}
    for bad, message in (("@Nobody", "no channel for handle @Nobody"), ("@Empty", "no uploads playlist for handle @Empty")):
        with open(f"{landed}/channels/Empty.json", "w") as f:
            json.dump({"items": [{"id": "UC_E", "contentDetails": {"relatedPlaylists": {}}}]}, f)
        asked = spark.createDataFrame([("@One",), (bad,)], "channel_handle string")
        with pytest.raises(ValueError, match=message):
            pipelines.extract_channels_to_snapshot(spark, landed, f"{tmp_dir}/d2", asked, 3, extraction_date=DAY2)
    # two names of one channel each get its videos; a channel without pages is in the summary
    with open(f"{landed}/channels/Quiet.json", "w") as f:
        json.dump({"items": [{"id": "UC_Q", "contentDetails": {"relatedPlaylists": {"uploads": "UU_Q"}}}]}, f)
    asked = spark.createDataFrame([("@One",), ("@@One",), ("@Quiet",)], "channel_handle string")
    path, summary = pipelines.extract_channels_to_snapshot(spark, landed, f"{tmp_dir}/d3", asked, 2, extraction_date=DAY2)
    got = {r.channel_handle: (r.videos_fetched, r.videos_returned) for r in summary.collect()}
    assert got == {"@One": (2, 2), "@@One": (2, 2), "@Quiet": (0, 0)}
    env = spark.read.json(path)
    assert {r.channel_handle: len(r.videos) for r in env.collect()} == {"@One": 2, "@@One": 2}


@pytest.mark.parametrize("per_batch", [1, 2])
def test_stream_gives_the_same_tables_for_any_batch_size(spark, tmp_dir, per_batch):
    """Two extractions with different videos, one of them a snapshot folder of several parts."""
    landed, data, store = f"{tmp_dir}/landed", f"{tmp_dir}/data", TableStore(spark, f"{tmp_dir}/tables")
    land(landed, 10)
    pipelines.extract_to_snapshot(spark, landed, data, "@MrChannel", extraction_date=DAY1)
    payload = {"channel_handle": "@MrChannel", "extraction_date": DAY2.isoformat(), "total_videos": 1,
               "videos": [{"title": "x", "duration": "PT1M", "video_id": "new", "like_count": "1", "view_count": "20",
                           "published_at": "2025-09-01T00:00:00Z", "comment_count": "0", "duration_readable": "1:00"}]}
    with open(f"{data}/youtube_videos_20251002_080000.json", "w") as f:
        json.dump(payload, f, indent=2)
    for _ in range(2):  # a restarted application finds its progress beside the store
        start_ingest(spark, data, store, clock=lambda: DAY2, files_per_batch=per_batch).awaitTermination(120)
    assert store.read("staging").count() == 4
    assert sorted(r.video_id for r in store.read("core").collect()) == ["a", "b", "c", "new"]
    assert sorted(r.video_id for r in store.read("history").collect()) == ["a", "b", "c", "new"]


def test_late_extraction_adds_and_does_not_overwrite(spark, tmp_dir):
    from clipstat import schemas
    from clipstat.streaming.ingest import process_envelopes

    store = TableStore(spark, f"{tmp_dir}/tables")
    video = lambda v, n: json.dumps({"title": "x", "video_id": v, "view_count": str(n), "published_at": "2025-09-01T00:00:00Z"})
    for day, videos in ((DAY2, [video("a", 20)]), (DAY1, [video("a", 10), video("old", 5)])):
        process_envelopes(spark.createDataFrame([("@c", day.isoformat(), len(videos), videos)], schemas.ENVELOPE_RAW), store, DAY2)
    assert {r.video_id: r.view_count for r in store.read("core").collect()} == {"a": 20, "old": 5}
    assert store.read("staging").count() == 3


def test_replayed_batch_loads_staging_once(spark, tmp_dir):
    from clipstat import schemas
    from clipstat.streaming.ingest import process_envelopes

    store = TableStore(spark, f"{tmp_dir}/tables")
    video = json.dumps({"title": "x", "video_id": "a", "published_at": "2025-09-01T00:00:00Z"})
    env = spark.createDataFrame([("@c", DAY1.isoformat(), 1, [video])], schemas.ENVELOPE_RAW)
    for epoch in (("s", 0), ("s", 0), ("s", 1), ("t", 0)):
        process_envelopes(env, store, DAY1, epoch=epoch)
    assert store.read("staging").count() == 3 and store.read("core").count() == 1


def test_constraints_fail_the_write(spark, tmp_dir):
    from clipstat.plans import fixtures as fx

    store = TableStore(spark, tmp_dir)
    core = fx.core_before(spark, "/root/testdata/sf0.001")
    too_long = core.withColumn("video_id", F.concat(F.col("video_id"), F.lit("x" * 20)))
    with pytest.raises(Exception) as e:
        table_sink.publish(store, too_long)
    assert "longer than 20" in str(e.value)
    no_title = core.withColumn("title", F.lit(None).cast("string"))
    with pytest.raises(Exception) as e:
        table_sink.publish(store, no_title)
    assert "core.title is NULL" in str(e.value)
    assert store.versions() == []                       # nothing became visible
