"""Hilbert curve, shard law and the written shards."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipstat.llm import sharding
from clipstat.llm.hilbert import hilbert_index
from tests.llm.helpers import awkward, documents, load, needs_tables


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    at = hilbert_index(points, bits)
    assert sorted(at) == list(range(len(points)))
    walk = points[np.argsort(at)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, got, shards):
    n = len(rows)
    assert len(got) == n
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    want = sorted([(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows], key=str)
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], key=str) == want
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in got)


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_awkward_rows(spark, shards):
    rows = awkward(2000) * 3
    check(rows, sharding.shard(documents(spark, rows, clash=True).repartition(3), shards).collect(), shards)


def test_empty_table(spark):
    assert sharding.shard(documents(spark, [])).count() == 0


def test_reruns_agree(spark):
    docs = documents(spark, awkward(500))
    one, two = (sorted([tuple(r) for r in sharding.shard(docs, 4).collect()], key=str) for _ in range(2))
    assert one == two


def test_cells_follow_the_cumulative_share(spark):
    docs = documents(spark, [(i, "t", "en", s) for i, s in enumerate(["b"] * 6 + ["a", "c"] + [None] * 2)])
    cells = {r["_value"]: r["_cell"] for r in sharding.value_cells(docs, "source", 8).collect()}
    assert cells == {"a": 0, "b": 25, "c": 179, None: 204}


def test_written_shards_and_manifest(spark, tmp_dir):
    rows = [r for r in awkward(200) if r[0] is not None]
    docs = documents(spark, rows)
    manifest = {r["shard"]: r for r in sharding.write_shards(docs, f"{tmp_dir}/shards", 3).collect()}
    back = spark.read.parquet(f"{tmp_dir}/shards").drop("_shard")
    assert sorted([tuple(r) for r in back.collect()], key=str) == sorted([tuple(r) for r in docs.collect()], key=str)
    assert sum(r["rows"] for r in manifest.values()) == len(rows)


def plain_shards(rows, shards):
    """``(doc_id, checksum, shard, slot)`` by the definition: equal-depth cells, curve, one sort, equal runs."""
    n = len(rows)

    def cells(values):
        order = sorted(values, key=lambda v: (v is None, v or ""))
        return {v: 256 * order.index(v) // n for v in set(values)}

    source, lang = cells([r[3] for r in rows]), cells([r[2] for r in rows])
    size = [len((r[1] or "").encode()) + 16 for r in rows]
    points = [[source[r[3]], lang[r[2]], min(255, math.floor(math.log2(z) * 8))] for r, z in zip(rows, size)]
    curve = hilbert_index(np.array(points), 8).tolist()
    crc = [zlib.crc32((r[1] or "").encode()) for r in rows]
    order = sorted(range(n), key=lambda i: (curve[i], rows[i][0] is None, rows[i][0] or 0, crc[i]))
    out, slot = [], {}
    for rank, i in enumerate(order):
        shard = rank * shards // n
        out.append((rows[i][0], crc[i], shard, slot.setdefault(shard, 0)))
        slot[shard] += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_equal_the_plain_version(spark, shards):
    rows = awkward(800) * 2 + [(100 + i, "x " * i, ["en", "fr", None, "de"][i % 4], ["a", "b", "b", "b", None][i % 5]) for i in range(120)]
    got = sharding.shard(documents(spark, rows).repartition(3), shards).collect()
    assert sorted(((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=str) == plain_shards(rows, shards)


def test_equal_rows_and_clashing_names_are_written_to_their_shards(spark, tmp_dir):
    rows = [(7, "the same text", "en", "a")] * 100 + [(None, None, None, None)] * 20
    docs = documents(spark, rows, clash=True).withColumn("_shard", F.lit("x")).withColumn("a.b", F.lit("y")).repartition(3)
    manifest = {r["shard"]: r["rows"] for r in sharding.write_shards(docs, f"{tmp_dir}/shards", 8).collect()}
    assert manifest == {s: 15 for s in range(8)}
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert set(back.columns) == {*docs.columns, "_shard_"} and back.count() == 120
    assert {r["_shard"] for r in back.collect()} == {"x"}
    assert sharding.write_shards(documents(spark, []), f"{tmp_dir}/none", 8).count() == 0


@needs_tables
def test_whole_table_prunes(spark):
    docs = load(spark, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sharding.shard(docs).collect()
    check(rows, got, 40)
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    shards_of = {}
    for r in got:
        shards_of.setdefault(lang[r["doc_id"]], set()).add(r["shard"])
    assert min(len(v) for v in shards_of.values()) < 30  # a language's rows sit in some shards only
