"""Extraction over landed pages: flatten, page stop, detail join, first n, summary."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clipstat.operators import extract
from clipstat.plans.pipelines import LandedLayout, channel_videos
from clipstat.sources import landed


def items_df(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "item string")


@pytest.mark.parametrize("duration,readable", [("PT2H0M7S", "2:00:07"), ("PT59S", "0:59"), ("PT61M", "1:01:00"),
                                               ("PT3S2M", "0:03"), ("P2D", "0:00"), (None, "0:00")])
def test_items_keep_their_fields_and_format_the_duration(spark, duration, readable):
    docs = [{"id": f"k{i}", "snippet": {"title": f"clip {i}", "publishedAt": f"2019-0{i}-11T00:00:09Z"},
             "statistics": {"viewCount": str(7 * i), "commentCount": str(i)}, "contentDetails": {"duration": duration}}
            for i in range(1, 4)]
    rows = sorted(extract.flatten_video_items(items_df(spark, docs)).collect(), key=lambda r: r.video_id)
    assert [(r.video_id, r.title, r.view_count, r.like_count, r.comment_count, r.published_at) for r in rows] == \
        [(f"k{i}", f"clip {i}", str(7 * i), "0", str(i), f"2019-0{i}-11T00:00:09Z") for i in range(1, 4)]
    assert {(r.duration, r.duration_readable) for r in rows} == {(duration, readable)}


def test_flatten_defaults(spark):
    docs = [
        {"id": "a", "snippet": {}},                                     # nothing but ids
        {"id": "b", "snippet": {"title": None}, "statistics": {"likeCount": None}},
        {"id": "c", "snippet": {"title": "t"}, "statistics": {"viewCount": 7}, "contentDetails": {}},
    ]
    rows = {r.video_id: r for r in extract.flatten_video_items(items_df(spark, docs)).collect()}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert a.title == "" and (a.like_count, a.view_count, a.comment_count) == ("0", "0", "0")
    assert a.duration is None and a.duration_readable == "0:00" and a.published_at is None
    assert b.title is None and b.like_count == "None"        # present null, as str(None)
    assert c.view_count == "7"


def test_flatten_without_snippet_fails(spark):
    with pytest.raises(PySparkException):
        extract.flatten_video_items(items_df(spark, [{"id": "x"}])).collect()


def pages_df(spark, pages):
    rows = [(n, [{"snippet": {"resourceId": {"videoId": v}}} for v in ids], tok) for n, ids, tok in pages]
    return spark.createDataFrame(rows, "page_no bigint, items array<struct<snippet:struct<resourceId:"
                                       "struct<videoId:string>>>>, nextPageToken string")


def crawled(spark, pages):
    return sorted(r.page_no for r in extract.crawled_pages(pages_df(spark, pages)).collect())


def test_page_stop(spark):
    full = [(1, ["a"], "t"), (2, ["b"], "t"), (3, ["c"], "t")]
    assert crawled(spark, full) == [1, 2, 3]
    assert crawled(spark, [(1, ["a"], "t"), (2, [], "t"), (3, ["c"], None)]) == [1]
    assert crawled(spark, [(1, ["a"], "t"), (2, ["b"], None), (3, ["c"], "t")]) == [1, 2]
    assert crawled(spark, [(1, ["a"], "t"), (2, ["b"], ""), (3, ["c"], "t")]) == [1, 2]
    assert crawled(spark, [(1, [], None), (2, ["b"], "t")]) == []
    assert crawled(spark, [(1, ["a"], None), (2, [], "t")]) == [1]


def test_playlist_ids_positions(spark):
    ids = extract.playlist_video_ids(pages_df(spark, [(1, ["a", "b"], "t"), (2, ["c"], None)]))
    assert [tuple(r) for r in ids.orderBy("page_no", "pos").collect()] == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def joined_videos(spark, pages, n_per_page, missing=()):
    rows = []
    for p in range(1, pages + 1):
        for i in range(n_per_page):
            vid = f"v{p}_{i}"
            if vid not in missing:
                rows.append((p, i, vid))
    return spark.createDataFrame(rows, "page_no bigint, pos int, video_id string")


def test_first_n_and_summary(spark):
    videos = joined_videos(spark, 3, 50)
    first = extract.first_n(videos, 120)
    assert first.count() == 120
    assert first.agg(F.max("page_no")).first()[0] == 3
    s = extract.extraction_summary(videos, 120).first()
    # whole pages until >= 120: pages 1..3 (150 videos), quota (150 // 50) * 2
    assert (s.videos_fetched, s.videos_returned, s.quota_units) == (150, 120, 6)


def test_summary_counts_after_detail_join(spark):
    # page 1 lost 10 videos in the detail join, so 3 pages are needed for 100
    videos = joined_videos(spark, 4, 50, missing={f"v1_{i}" for i in range(10)})
    s = extract.extraction_summary(videos, 100).first()
    assert (s.videos_fetched, s.videos_returned, s.quota_units) == (140, 100, 4)


def test_summary_fewer_than_n(spark):
    s = extract.extraction_summary(joined_videos(spark, 2, 10), 200).first()
    assert (s.videos_fetched, s.videos_returned, s.quota_units) == (20, 20, 0)


def test_first_n_plan_is_bounded_top_n(spark):
    plan = extract.first_n(joined_videos(spark, 2, 5), 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_resolve_channels(spark):
    req = spark.createDataFrame([(1, "@@abc"), (2, "abc"), (3, "@zzz")], "request_id int, channel_handle string")
    listing = spark.createDataFrame([("@abc", "UC1", "UU1")], "handle string, channel_id string, uploads_playlist_id string")
    rows = {r.request_id: r for r in extract.resolve_channels(req, listing).collect()}
    assert rows[1].channel_id == "UC1" and rows[1].channel_handle == "@@abc"
    assert rows[2].uploads_playlist_id == "UU1"
    assert rows[3].channel_id is None
    with pytest.raises(PySparkException):
        extract.resolve_channels(req, listing, strict=True).collect()


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f, indent=2, ensure_ascii=False)


def land_channel(root, handle="MrChannel", playlist="UU_X", pages=None, videos=None):
    write_json(f"{root}/channels/{handle}.json",
               {"items": [{"id": "UC_X", "contentDetails": {"relatedPlaylists": {"uploads": playlist}}}]})
    for n, (ids, token) in (pages or {}).items():
        page = {"items": [{"snippet": {"resourceId": {"videoId": v}}} for v in ids]}
        if token:
            page["nextPageToken"] = token
        write_json(f"{root}/playlists/playlist_id={playlist}/page_{n:05d}.json", page)
    for n, items in (videos or {}).items():
        write_json(f"{root}/videos/playlist_id={playlist}/page_{n:05d}.json", {"items": items})


def test_landed_pages_read(spark, tmp_dir):
    land_channel(tmp_dir, pages={1: (["a", "b"], "tok"), 2: (["c"], None)})
    pages = landed.read_playlist_pages(spark, f"{tmp_dir}/playlists/playlist_id=UU_X")
    got = sorted((r.page_no, len(r["items"]), r.nextPageToken) for r in pages.collect())
    assert got == [(1, 2, "tok"), (2, 1, None)]
    listing = landed.read_channel_listing(spark, f"{tmp_dir}/channels").first()
    assert (listing.handle, listing.channel_id, listing.uploads_playlist_id) == ("MrChannel", "UC_X", "UU_X")


def clip(vid, views=3, **other):
    return {"id": vid, "snippet": {"title": vid.upper(), "publishedAt": "2021-05-06T07:08:09Z"},
            "statistics": {"viewCount": views}, "contentDetails": {"duration": "PT75S"}, **other}


def test_videos_come_in_the_order_of_the_responses(spark, tmp_dir):
    """Ids a, b, a answered by b, a give b, a: order and multiplicity are the response's; ids
    without an item vanish, and pages after the last crawled one are not read."""
    land_channel(tmp_dir, pages={1: (["a", "b", "a"], "t"), 2: (["x", "c"], None), 3: (["d"], "t")},
                 videos={1: [clip("b"), clip("a")], 2: [clip("c", statistics={})], 3: [clip("d")]})
    for n, want in ((None, ["b", "a", "c"]), (1, ["b"]), (2, ["b", "a"])):
        videos, summary = channel_videos(spark, LandedLayout(tmp_dir), "@@MrChannel", max_results=n)
        rows = videos.orderBy("page_no", "pos").collect()
        assert [r.video_id for r in rows] == want
        s = summary.first()
        assert (s.videos_fetched, s.videos_returned) == ({None: 3, 1: 2, 2: 2}[n], len(want))
    assert rows[0].duration_readable == "1:15" and rows[0].title == "B"


def test_item_without_id_fails(spark, tmp_dir):
    land_channel(tmp_dir, pages={1: (["a"], None)}, videos={1: [{"snippet": {"title": "t"}}]})
    with pytest.raises(Exception, match="video item without id"):
        channel_videos(spark, LandedLayout(tmp_dir), "@MrChannel")[0].collect()


def test_unknown_channel_and_missing_uploads_fail(spark, tmp_dir):
    land_channel(tmp_dir, pages={1: (["vid1"], None)}, videos={1: []})
    write_json(f"{tmp_dir}/channels/NoUploads.json", {"items": [{"id": "UC_N", "contentDetails": {"relatedPlaylists": {}}}]})
    with pytest.raises(ValueError, match="no channel for handle @Nobody"):
        channel_videos(spark, LandedLayout(tmp_dir), "@Nobody")
    with pytest.raises(ValueError, match="no uploads playlist for handle @NoUploads"):
        channel_videos(spark, LandedLayout(tmp_dir), "@NoUploads")


def test_many_playlists_match_one_at_a_time(spark):
    """Per-playlist crawl, first n and summary equal running each playlist alone."""
    spec = {"A": [(1, ["a1", "a2"], "t"), (2, ["a3"], "t"), (3, [], "t"), (4, ["a4"], None)],
            "B": [(1, ["b1"], None), (2, ["b2"], "t")],
            "C": [(n, [f"c{n}_{i}" for i in range(3)], "t") for n in range(1, 40)]}     # a hot playlist
    rows = [(pl, n, [{"snippet": {"resourceId": {"videoId": v}}} for v in ids], tok)
            for pl, pages in spec.items() for n, ids, tok in pages]
    pages = spark.createDataFrame(rows, "playlist_id string, page_no bigint, items array<struct<snippet:struct<"
                                        "resourceId:struct<videoId:string>>>>, nextPageToken string")
    crawled = extract.crawled_pages(pages, by=["playlist_id"])
    ids = crawled.select("playlist_id", "page_no", F.posexplode("items").alias("pos", "_")).drop("_")
    many_first = sorted(tuple(r) for r in extract.first_n(ids, 5, by=["playlist_id"]).collect())
    many_summary = {r.playlist_id: (r.videos_fetched, r.videos_returned, r.quota_units)
                    for r in extract.extraction_summary(ids, 5, by=["playlist_id"]).collect()}
    for pl in spec:
        one_pages = pages.where(F.col("playlist_id") == pl).drop("playlist_id")
        one_ids = extract.playlist_video_ids(extract.crawled_pages(one_pages)).drop("video_id")
        want_first = sorted((pl,) + tuple(r) for r in extract.first_n(one_ids, 5).collect())
        assert [r for r in many_first if r[0] == pl] == want_first
        s = extract.extraction_summary(one_ids, 5).first()
        assert many_summary[pl] == (s.videos_fetched, s.videos_returned, s.quota_units)
    assert many_summary["A"] == (3, 3, 0) and many_summary["B"] == (1, 1, 0) and many_summary["C"] == (6, 5, 0)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    plan = extract.first_n(ids, 5, by=["playlist_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    try:
        spark.conf.set(key, "3")  # beyond the threshold the pages are told first, with the same rows
        beyond = extract.first_n(ids, 5, by=["playlist_id"])
        assert sorted(tuple(r) for r in beyond.collect()) == many_first
        assert "WindowGroupLimit" not in beyond._jdf.queryExecution().executedPlan().toString() and spark.conf.get(key) == "3"
    finally:
        spark.conf.set(key, old)


def test_first_of_several_landed_names_counts(spark):
    """``@A`` and ``A`` both landed: a request still gives one row, from the first by name."""
    listing = spark.createDataFrame([("A", "id2", "UU_2"), ("@A", "id1", "UU_1"), ("B", "id3", None)],
                                    "handle string, channel_id string, uploads_playlist_id string")
    req = spark.createDataFrame([(1, "@@A"), (2, "B"), (3, "C")], "request_id int, channel_handle string")
    rows = {r.request_id: (r.channel_id, r.uploads_playlist_id) for r in extract.resolve_channels(req, listing).collect()}
    assert rows == {1: ("id1", "UU_1"), 2: ("id3", None), 3: (None, None)}
    assert extract.resolve_channels(req, listing).count() == 3


@pytest.mark.parametrize("named", [1000, 1])
def test_only_the_playlists_asked_for_are_read(spark, tmp_dir, named):
    """Two of 200 landed playlists: their two folders are read, named to the scan or pruned by the join."""
    from tests.test_store import leaves

    root = f"{tmp_dir}/playlists"
    for n in range(200):
        write_json(f"{root}/playlist_id=UU_{n}/page_00001.json", {"items": [{"snippet": {"resourceId": {"videoId": f"v{n}"}}}]})
    wanted = spark.createDataFrame([("UU_7",), ("UU_150",), ("UU_nothing_landed",), ("UU_7",)], "playlist_id string")
    wanted.write.parquet(f"{tmp_dir}/wanted")
    pages = landed.read_playlists(spark, root, spark.read.parquet(f"{tmp_dir}/wanted"), named=named)
    ids = pages.select("playlist_id", "page_no", F.col("items")[0]["snippet"]["resourceId"]["videoId"].alias("v"))
    assert sorted(map(tuple, ids.collect())) == [("UU_150", 1, "v150"), ("UU_7", 1, "v7")]
    read = [m["numFiles"] for name, m in leaves(ids) if name.startswith("Scan json")]
    assert read == [2]
    assert landed.read_playlists(spark, root, wanted.where("false"), named=named).count() == 0


def test_crawl_from_heads_equals_the_crawl_from_pages(spark):
    pages = pages_df(spark, [(1, ["a"], "t"), (2, ["b"], "t"), (3, [], "t"), (4, ["c"], "t")])
    heads = extract.page_heads(pages)
    assert heads.columns == ["page_no", "n_ids", "nextPageToken"]
    assert sorted(r.page_no for r in extract.crawled_pages(heads).collect()) == sorted(r.page_no for r in extract.crawled_pages(pages).collect()) == [1, 2]


def shop_tables(spark, root, orders, parts=100):
    """``lineitem`` of two lines an order and ``part``, as the fixtures read them; gives the rows back."""
    lines = [(k, n, part) for k in range(orders) for n, part in ((1, k % parts), (2, (k * 7 + 1) % parts))]
    spark.createDataFrame([(k, n, part, part % 7, float(n), 1.5 * part) for k, n, part in lines],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double") \
         .withColumn("l_shipdate", F.lit("1999-01-02 00:00:00").cast("timestamp_ntz")).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(p, f"part {p}", p % 50 + 1) for p in range(parts)], "p_partkey bigint, p_name string, p_size int") \
         .coalesce(1).write.parquet(f"{root}/part.parquet")
    return lines


def test_a_short_crawl_of_many_pages_is_joined_before_the_responses_are_built(spark, tmp_dir):
    """All pages' heads are too large to be broadcast, the crawled pages' keys are not: the join by them
    comes below the grouping of the responses."""
    from clipstat.plans import fixtures as fx
    from clipstat.plans import registry

    parts, want = {}, {}
    for k, _, part in shop_tables(spark, tmp_dir, 30000):
        parts.setdefault(k, set()).add(part)
    for playlist in range(fx.PLAYLISTS):
        fetched = 0
        for k in range(playlist, 30000, fx.PLAYLISTS):
            if k % 97 == 13 or fetched >= fx.CHANNEL_RESULTS:
                break
            fetched += sum((p % 50 + 1) % 10 != 0 for p in parts[k])
            if k % 89 == 5:
                break
        if fetched:
            want[f"U{playlist}"] = (fetched, min(fetched, fx.CHANNEL_RESULTS), fetched // 50 * 2)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        made = registry.channel_summary(spark, tmp_dir)
        assert {r.playlist_id: (r.videos_fetched, r.videos_returned, r.quota_units) for r in made.collect()} == want
        for query in (made, registry.channel_extract(spark, tmp_dir)):
            plan = query._jdf.queryExecution().optimizedPlan().toString()
            assert plan.index("collect_list") < plan.index("LeftSemi")
    finally:
        spark.conf.set(key, old)


def test_responses_are_grouped_from_few_columns_of_a_part(spark, tmp_dir):
    """What is shuffled to group a page is a line's or a part's few columns: no item's maps, no prices or dates.
    Repeated lines count once in a response, repeated parts each time; a null name is kept."""
    from clipstat.plans import fixtures as fx

    spark.createDataFrame([(1, 1, 3, 9.5), (1, 2, 4, 1.5), (1, 2, 4, 2.5), (1, 3, 5, 0.5), (2, 1, 10, 7.5), (2, 2, None, 7.5), (None, 1, 3, 1.5)],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double") \
         .selectExpr("*", "1 AS l_suppkey", "2.5D AS l_quantity", "TIMESTAMP_NTZ'1999-01-02 00:00:00' AS l_shipdate").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(3, "c", 1), (4, None, 30), (4, "d", 7), (5, "e", 12), (5, "e", 12), (10, "x", None)],
                          "p_partkey bigint, p_name string, p_size int").write.parquet(f"{tmp_dir}/part.parquet")
    answers = fx.detail_pages(spark, tmp_dir)
    got = {r.page_no: (r.playlist_id, [(x["id"], x.snippet["title"], x.statistics["likeCount"], x.contentDetails["duration"]) for x in r["items"]])
           for r in answers.collect()}
    assert got == {1: ("U1", [("5", "e", "12", "PT3M5S"), ("5", "e", "12", "PT3M5S"), ("4", "d", "7", "PT2M28S"), ("3", "c", "1", "PT1M51S")]),
                   None: (None, [("3", "c", "1", "PT1M51S")])}
    assert answers.schema["items"].dataType.elementType == fx.details(spark, tmp_dir).schema["item"].dataType
    asked = fx.pages(spark, tmp_dir)
    assert {r.page_no: [x.snippet.resourceId.videoId for x in r["items"]] for r in asked.collect()} == {1: ["3", "4", "4", "5"], 2: ["10", None], None: ["3"]}
    for made, absent in ((answers, ["map("]), (asked, ["l_shipdate", "l_extendedprice", "l_quantity"])):
        plan = made._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("partial_collect_list"):]
        assert [text for text in absent if text in below] == []
