"""Snapshot envelopes: newest-by-name choice, reading, staging rows, writing."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.operators.staging import explode_envelope
from clipstat.sinks.envelope import EmptySnapshotError, envelope_rows, snapshot_name, write_snapshot
from clipstat.sources import snapshots

AS_OF = dt.datetime(2025, 10, 4, 8, 0, 0)


def video(vid, **kw):
    base = {"title": f"title {vid}", "duration": "PT1M30S", "video_id": vid, "like_count": "10",
            "view_count": "100", "published_at": "2025-10-03T10:00:00Z", "comment_count": "5",
            "duration_readable": "1:30"}
    base.update(kw)
    return {k: v for k, v in base.items() if v is not ...}


def write_envelope(folder, name, videos, handle="@MrChannel", when="2025-10-03T12:30:45.123456"):
    os.makedirs(folder, exist_ok=True)
    payload = {"channel_handle": handle, "extraction_date": when, "total_videos": len(videos), "videos": videos}
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(payload, f, indent=2, ensure_ascii=False)
    return os.path.join(folder, name)


def test_latest_snapshot_by_name(spark, tmp_dir):
    write_envelope(tmp_dir, "youtube_videos_20251003_120000.json", [video("a")])
    write_envelope(tmp_dir, "youtube_videos_20251004_120000.json", [video("b")])
    assert snapshots.latest_snapshot_path(spark, tmp_dir).endswith("20251004_120000.json")
    write_envelope(tmp_dir, "zzz.json", [video("c")])          # name order, not time order
    assert snapshots.latest_snapshot_path(spark, tmp_dir).endswith("zzz.json")


def test_snapshot_source_guards(spark, tmp_dir):
    with pytest.raises(snapshots.SnapshotSourceError):
        snapshots.latest_snapshot_path(spark, os.path.join(tmp_dir, "missing"))
    open(os.path.join(tmp_dir, "notes.txt"), "w").close()
    with pytest.raises(snapshots.SnapshotSourceError):
        snapshots.latest_snapshot_path(spark, tmp_dir)


def test_staging_rows(spark, tmp_dir):
    path = write_envelope(tmp_dir, "s.json", [
        video("a"),
        video("b", like_count=..., comment_count=..., view_count=...),     # missing keys -> 0
        video("c", published_at="2025-10-03T10:00:00+02:00", title="Café ☕"),
    ])
    rows = explode_envelope(snapshots.read_envelopes(spark, path), loaded_at=AS_OF)
    assert rows.columns == [c for c in schemas.STAGING.fieldNames() if c != "extraction_id"]
    got = {r.video_id: r for r in rows.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.like_count, a.view_count, a.comment_count) == (10, 100, 5)
    assert (b.like_count, b.view_count, b.comment_count) == (0, 0, 0)
    assert a.channel_handle == "@MrChannel" and a.total_videos == 3
    assert a.extraction_date == dt.datetime(2025, 10, 3, 12, 30, 45, 123456)   # microseconds kept
    assert a.published_at == dt.datetime(2025, 10, 3, 10, 0, 0)
    assert c.published_at == dt.datetime(2025, 10, 3, 8, 0, 0)                  # offset applied
    assert c.title == "Café ☕"
    assert a.loaded_at == AS_OF
    assert json.loads(a.raw_data)["video_id"] == "a"


def test_staging_explicit_null_count(spark, tmp_dir):
    path = write_envelope(tmp_dir, "s.json", [video("a", like_count=None)])
    env = snapshots.read_envelopes(spark, path)
    assert explode_envelope(env, AS_OF).first().like_count == 0               # lenient default
    with pytest.raises(PySparkException):
        explode_envelope(env, AS_OF, strict=True).collect()                   # as int(None) raises


def test_staging_requires_published_at_and_numeric_counts(spark, tmp_dir):
    path = write_envelope(tmp_dir, "s.json", [video("a", published_at=None)])
    with pytest.raises(PySparkException):
        explode_envelope(snapshots.read_envelopes(spark, path), AS_OF).collect()
    path = write_envelope(tmp_dir, "t.json", [video("a", like_count="None")])
    with pytest.raises(PySparkException):
        explode_envelope(snapshots.read_envelopes(spark, path), AS_OF).collect()


def flat_videos(spark, n_pages, per_page):
    rows = [(p, i, f"t{p}.{i}", None if i % 2 else "PT1M", f"v{p}_{i}", "1", "2", "2025-01-01T00:00:00Z", "3",
             "1:00") for p in range(n_pages) for i in range(per_page)]
    return spark.createDataFrame(rows, "page_no bigint, pos int, " + ", ".join(f"{c} string" for c in schemas.VIDEO_FIELDS))


def test_write_and_read_snapshot(spark, tmp_dir):
    at = dt.datetime(2025, 10, 3, 12, 30, 45, 123456)
    path = write_snapshot(flat_videos(spark, 3, 4), tmp_dir, "@MrChannel", at, pages_per_chunk=2)
    assert path.endswith(snapshot_name(at)) and snapshot_name(at) == "youtube_videos_20251003_123045.json"
    assert snapshots.latest_snapshot_path(spark, tmp_dir) == path
    env = snapshots.read_envelopes(spark, path)
    assert env.count() == 2                                                   # two chunks
    assert {r.total_videos for r in env.collect()} == {12}
    rows = explode_envelope(env, AS_OF)
    assert rows.count() == 12
    assert rows.select("extraction_date").distinct().first()[0] == at
    r = rows.where("video_id = 'v0_1'").first()
    assert r.duration is None and json.loads(r.raw_data)["duration"] is None  # nulls are written
    # order inside a chunk follows (page, pos)
    first_chunk = [json.loads(v)["video_id"] for v in env.orderBy(F.size("videos").desc()).first().videos]
    assert first_chunk == sorted(first_chunk, key=lambda v: tuple(int(x) for x in v[1:].split("_")))


def test_envelope_iso_text_without_fraction(spark):
    env = envelope_rows(flat_videos(spark, 1, 1), "@c", dt.datetime(2025, 1, 2, 3, 4, 5)).first()
    assert env.extraction_date == "2025-01-02T03:04:05"


def test_empty_snapshot_refused(spark, tmp_dir):
    with pytest.raises(EmptySnapshotError):
        write_snapshot(flat_videos(spark, 1, 1).limit(0), tmp_dir, "@c", AS_OF)


def test_incomplete_snapshot_folder_is_skipped(spark, tmp_dir):
    at = dt.datetime(2025, 10, 3, 12, 0, 0)
    done = write_snapshot(flat_videos(spark, 1, 2), tmp_dir, "@c", at)
    broken = os.path.join(tmp_dir, "youtube_videos_20251004_120000.json")
    os.makedirs(broken)                                   # a write that died before its commit
    open(os.path.join(broken, "part-00000.json"), "w").close()
    assert snapshots.latest_snapshot_path(spark, tmp_dir) == done


def test_typed_envelope_read(spark, tmp_dir):
    path = write_envelope(tmp_dir, "s.json", [video("a"), video("b", duration=None)])
    env = snapshots.read_envelopes(spark, path, raw=False)
    assert dict(env.dtypes)["extraction_date"] == "timestamp_ntz"
    rows = {r.video_id: r for r in env.select("channel_handle", "extraction_date", "total_videos", F.explode("videos").alias("v"))
            .select("*", "v.*").collect()}
    assert rows["a"].channel_handle == "@MrChannel" and rows["a"].total_videos == 2
    assert rows["a"].extraction_date == dt.datetime(2025, 10, 3, 12, 30, 45, 123456)
    assert rows["b"].duration is None and rows["a"].like_count == "10"


@pytest.mark.parametrize("key", ["channel_handle", "extraction_date", "total_videos", "videos"])
def test_envelope_without_a_required_key_fails(spark, tmp_dir, key):
    doc = {"channel_handle": "@c", "extraction_date": "2025-10-03T12:00:00", "total_videos": 1, "videos": [video("a")]}
    del doc[key]
    path = os.path.join(tmp_dir, "s.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    with pytest.raises(Exception, match=key):
        explode_envelope(snapshots.read_envelopes(spark, path), AS_OF).collect()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_publication_time_is_utc_in_every_session_zone(spark, zone):
    from clipstat.functions.columns import parse_published_at

    texts = ["2025-10-03T10:00:00Z", "2025-10-03T10:00:00+05:30", "2025-10-03T10:00:00.25Z", "2025-10-03T10:00:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_published_at("t").alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ten = dt.datetime(2025, 10, 3, 10)
    assert {r.t: r.p for r in rows} == {texts[0]: ten, texts[1]: dt.datetime(2025, 10, 3, 4, 30),
                                        texts[2]: ten + dt.timedelta(milliseconds=250), texts[3]: ten}
