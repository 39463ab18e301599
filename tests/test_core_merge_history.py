"""Latest / dedupe / projection, the upsert in both plans and modes, daily history."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from clipstat import schemas
from clipstat.operators import core as core_ops
from clipstat.operators import history, merge

D1, D2 = dt.datetime(2025, 10, 1, 9, 0), dt.datetime(2025, 10, 2, 9, 0)
T0, T1, T2 = dt.datetime(2025, 10, 1, 10, 0), dt.datetime(2025, 10, 2, 10, 0), dt.datetime(2025, 10, 2, 11, 0)
PUB = dt.datetime(2025, 9, 1)

STG = ("extraction_id bigint, channel_handle string, extraction_date timestamp_ntz, video_id string, "
       "title string, duration_readable string, like_count bigint, view_count bigint, comment_count bigint, "
       "published_at timestamp_ntz, loaded_at timestamp_ntz")


def staging(spark, rows):
    return spark.createDataFrame(rows, STG)


def test_latest_is_global_or_per_channel(spark):
    df = staging(spark, [(1, "@a", D1, "v1", "t", "1:00", 1, 1, 1, PUB, T0),
                         (2, "@b", D2, "v2", "t", "1:00", 1, 1, 1, PUB, T1)])
    assert [r.video_id for r in core_ops.latest_extraction(df).collect()] == ["v2"]
    assert sorted(r.video_id for r in core_ops.latest_extraction(df, per="channel_handle").collect()) == ["v1", "v2"]


def test_dedupe_newest_with_tie_break(spark):
    df = staging(spark, [(1, "@a", D1, "v1", "old", "1:00", 1, 1, 1, PUB, T0),
                         (2, "@a", D1, "v1", "tie-low", "1:00", 1, 1, 1, PUB, T1),
                         (3, "@a", D1, "v1", "tie-high", "1:00", 1, 1, 1, PUB, T1),
                         (4, "@a", D1, "v2", "only", "1:00", 1, 1, 1, PUB, T0)])
    got = {r.video_id: r.title for r in core_ops.dedupe_newest(df).collect()}
    assert got == {"v1": "tie-high", "v2": "only"}


def test_dedupe_plan_limits_before_shuffle(spark):
    df = staging(spark, [(1, "@a", D1, "v1", "t", "1:00", 1, 1, 1, PUB, T0)])
    plan = core_ops.dedupe_newest(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_projection(spark):
    df = staging(spark, [(1, "@a", D1, "v1", "t", "1:02:03", 10, 100, 5, PUB, T0),
                         (2, "@a", D1, "v2", "t", None, None, None, None, PUB, T0),
                         (3, "@a", D1, "v3", "t", "0:45", 1, 20000, 0, PUB, T0)])
    got = {r.video_id: r for r in core_ops.core_projection(df).collect()}
    assert core_ops.core_projection(df).columns == schemas.CORE_COLUMNS
    v1, v2, v3 = got["v1"], got["v2"], got["v3"]
    assert (v1.duration_seconds, v1.content_type, v1.is_short, v1.engagement_ratio) == (3723, "Long", False, Decimal("0.1500"))
    assert (v2.duration_seconds, v2.content_type, v2.is_short, v2.like_count, v2.engagement_ratio) == \
        (None, "Long", False, 0, Decimal("0.0000"))
    assert (v3.content_type, v3.is_short, v3.engagement_ratio) == ("Short", True, Decimal("0.0001"))


CORE_ROW = dict(title="t", duration_seconds=60, duration_formatted="1:00", like_count=1, view_count=10,
                comment_count=0, published_at=PUB, channel_handle="@a", content_type="Short",
                engagement_ratio=Decimal("0.1000"), is_short=True, extraction_date=D1)


def core_df(spark, rows, with_updated=True):
    cols = schemas.CORE_COLUMNS + (["updated_at"] if with_updated else [])
    data = []
    for r in rows:
        full = dict(CORE_ROW, **r)
        data.append(tuple(full[c] for c in cols))
    fields = [T.StructField(f.name, f.dataType, True) for f in schemas.CORE.fields if f.name in cols]
    schema = T.StructType(fields)
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("strategy", ["split", "shuffle"])
def test_upsert_sticky(spark, strategy):
    target = core_df(spark, [dict(video_id="keep", updated_at=T0),
                             dict(video_id="upd", updated_at=T0, title="old", like_count=1)])
    source = core_df(spark, [dict(video_id="upd", title="new", like_count=99, published_at=dt.datetime(2020, 1, 1),
                                  channel_handle="@other", extraction_date=D2),
                             dict(video_id="ins", extraction_date=D2)], with_updated=False)
    out = {r.video_id: r for r in merge.upsert(target, source, T2, strategy=strategy).collect()}
    assert set(out) == {"keep", "upd", "ins"}
    assert out["keep"].updated_at == T0
    u = out["upd"]
    assert (u.title, u.like_count, u.updated_at) == ("new", 99, T2)
    assert (u.published_at, u.channel_handle, u.extraction_date) == (PUB, "@a", D1)   # sticky
    assert out["ins"].extraction_date == D2 and out["ins"].updated_at == T2


@pytest.mark.parametrize("strategy", ["split", "shuffle"])
def test_upsert_refresh(spark, strategy):
    target = core_df(spark, [dict(video_id="upd", updated_at=T0)])
    source = core_df(spark, [dict(video_id="upd", extraction_date=D2, channel_handle="@other")], with_updated=False)
    u = merge.upsert(target, source, T2, refresh=("extraction_date",), strategy=strategy).first()
    assert u.extraction_date == D2 and u.channel_handle == "@a"


def test_upsert_strategies_agree_and_are_idempotent(spark):
    target = core_df(spark, [dict(video_id=f"t{i}", updated_at=T0, like_count=i) for i in range(30)])
    source = core_df(spark, [dict(video_id=f"t{i}", like_count=100 + i, extraction_date=D2) for i in range(20, 40)],
                     with_updated=False)
    a = merge.upsert(target, source, T2, strategy="split")
    b = merge.upsert(target, source, T2, strategy="shuffle")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(a) == key(b) and a.count() == 40
    again = merge.upsert(a, source, T2)
    assert key(again) == key(a)


def test_small_source_is_broadcast_at_run_time_and_large_is_not(spark, tmp_dir):
    core_df(spark, [dict(video_id=f"t{i}", updated_at=T0) for i in range(200)]).write.parquet(tmp_dir + "/t")
    core_df(spark, [dict(video_id="b")], with_updated=False).write.parquet(tmp_dir + "/s")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = {}
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = merge.upsert(spark.read.parquet(tmp_dir + "/t"), spark.read.parquet(tmp_dir + "/s"), T2)
            assert out.count() == 201
            plans[threshold] = out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plans["10MB"] and "BroadcastHashJoin" not in plans["-1"]


HIST = "history_id bigint, video_id string, like_count bigint, view_count bigint, comment_count bigint, recorded_at timestamp_ntz"


def test_history_once_per_day_for_latest_extraction(spark):
    core = core_df(spark, [dict(video_id="new", extraction_date=D2, updated_at=T1),
                           dict(video_id="old", extraction_date=D1, updated_at=T1),
                           dict(video_id="seen", extraction_date=D2, updated_at=T1),
                           dict(video_id=None, extraction_date=D2, updated_at=T1)])
    stg = spark.createDataFrame([(D1,), (D2,)], "extraction_date timestamp_ntz")
    hist = spark.createDataFrame([(1, "seen", 1, 1, 1, T1), (2, "new", 1, 1, 1, T0)], HIST)
    rows = history.new_history_rows(core, stg, hist, T2).collect()
    # "old" is not from the latest extraction; "seen" already has a row today;
    # "new" only has one from yesterday; a NULL key is kept (NOT EXISTS semantics).
    assert sorted((r.video_id or "") for r in rows) == ["", "new"]
    assert all(r.recorded_at == T2 for r in rows)
    counts = history.today_counts(core, hist, T2).first()
    assert (counts.core_rows, counts.history_today_rows) == (4, 1)


def test_history_per_channel_uses_each_channels_newest_extraction(spark):
    core = core_df(spark, [dict(video_id="a", channel_handle="@a", extraction_date=D1, updated_at=T1),
                           dict(video_id="b", channel_handle="@b", extraction_date=D2, updated_at=T1),
                           dict(video_id="b_old", channel_handle="@b", extraction_date=D1, updated_at=T1),
                           dict(video_id="none", channel_handle=None, extraction_date=D1, updated_at=T1)])
    stg = spark.createDataFrame([("@a", D1), ("@b", D1), ("@b", D2), (None, D1)], "channel_handle string, extraction_date timestamp_ntz")
    hist = spark.createDataFrame([], HIST)
    rows = history.new_history_rows(core, stg, hist, T2, per="channel_handle").collect()
    assert sorted(r.video_id for r in rows) == ["a", "b", "none"]


def test_serial_ids_unique_and_after_base(spark, monkeypatch):
    rows = spark.range(1000).repartition(7).withColumnRenamed("id", "x")
    ids = [r.rid for r in history.serial_ids(rows, 41, "rid").collect()]
    assert len(set(ids)) == 1000 and min(ids) == 42
    from clipstat.sources import tables

    monkeypatch.setattr(tables, "ROWS_PER_PARTITION", 10)
    with pytest.raises(Exception, match="append too large"):
        history.serial_ids(rows, 41, "rid").collect()
