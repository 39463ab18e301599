"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clipstat.llm import topk
from tests.llm.helpers import load, needs_tables

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every, k=5):
    import struct

    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    ok = [(i, [math.floor(256 * f32(x)) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in ok if i % every == 0}:
        mine = min(v for i, v in ok if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def found(df, every, **options):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, **options).collect())


def cloud(n, dim, seed, copies=0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], 0) for i in range(n)]
    return rows + [(n + i, rows[0][1], 0) for i in range(copies)]


@pytest.mark.parametrize("options", [{}, {"block": 4, "group": 40, "chunk": 3}, {"block": 1, "group": 7, "chunk": 1}])
def test_equals_brute_force(spark, options):
    rows = cloud(300, 8, 1, copies=60)  # a large group of equal vectors: ties go to smaller ids
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("grp", F.lit(1)).repartition(3)
    assert found(df, 10, **options) == plain(rows, 10)


def test_blocks_are_left_out_where_vectors_differ():
    """Rows around five centres: a query scores few of the blocks, and finds the same as a full scan."""
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (5, 16)) * 256
    rows = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(0, 8, (1000, 16))).astype(np.int64)
    index = topk.BlockIndex(np.arange(1000), rows, 20)
    asked, scored = rows[::50], []
    got = list(topk.search(index, np.arange(0, 1000, 50), asked, np.full(20, -topk.MOST), 5, scored))
    want = []
    for q in range(0, 1000, 50):
        best = sorted((-int(s), i) for i, s in enumerate(rows @ rows[q]) if i != q)[:5]
        want += [(q, i, -s) for s, i in best]
    assert sorted(got) == sorted(want) and len(scored) == 20
    assert sum(scored) < 0.3 * 20 * 50, sum(scored) / (20 * 50)
    exact = rows[::50] @ rows.T
    for b, (lo, hi) in enumerate(zip(index.cuts, index.ends)):
        assert (index.bounds(asked)[:, b] >= exact[:, lo:hi].max(axis=1)).all() and (index.ball_bounds(asked)[:, b] >= exact[:, lo:hi].max(axis=1)).all()


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [float("nan"), 1.0], 0), (3, [float("inf"), 1.0], 0), (4, [None, 1.0], 0), (None, [1.0, 1.0], 0),
            (5, [0.5], 0), (6, [], 0), (10, [-1.0, 3.0], 0), (7, [1.0, 2.0], 0), (8, [1.0, 2.0], None), (0, [1.0, 2.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, 10)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 0)], [(1, [1.0], 0)], [(0, [], 0), (1, [], 0)], [(0, None, 0)]])
def test_few_rows(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, 10)


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(1 << 20)) for _ in range(4)], 0) for i in range(30)]
    assert found(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, 10)


def test_components_of_any_size_are_not_clipped(spark):
    rows = [(0, [1e10, 0.0], 0), (1, [0.0078125, 0.0], 0), (2, [-3e2, 1.0], 0), (3, [0.00390625, 1e8], 0), (4, [1e3, -2e4], 0), (10, [-1e-9, 5e4], 0)]
    got = found(spark.createDataFrame(rows, SCHEMA), 10)
    assert got == plain(rows, 10)
    assert {(q, i): s for q, _, i, s in got}[0, 1] == 2 * 2560000000000
    # a score that 64 bits cannot hold is their limit
    over = found(spark.createDataFrame([(0, [1e30, 1e30], 0), (1, [1e30, 0.0], 0), (2, [-1e30, 0.0], 0)], SCHEMA), 10)
    assert over == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, 1 - (1 << 63))]


@needs_tables
def test_whole_table(spark):
    df = load(spark, "embeddings")
    assert found(df, 50, block=16, group=128, chunk=4) == plain([tuple(r) for r in df.collect()], 50)
