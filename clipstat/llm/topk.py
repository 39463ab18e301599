"""Exact top-k inner products by block-at-a-time pruning.

Components are quantised to ``floor(256 * x)``; a component is a term and its value the term's
weight.  Vectors are ordered so that similar ones are neighbours (by the nearest of a bounded
sample of pivots) and cut into blocks of ``block`` rows.  The index keeps, for each block, the
largest and smallest weight of every term, its centre and the distance of the farthest row from it, and a
forward index (ids and weights, one row each).

A query's bound on a block is the sum over terms of the most that the term can add (largest weight
for a positive query weight, smallest for a negative one).  Each query visits blocks in the order of
their bounds, scores a whole block through its forward index and stops as soon as the next bound is
below its k-th score (a block whose bound equals it is still scored, as a smaller id may win a tie).
On the way it leaves out blocks whose rows are all too near their centre to reach that score: the product
with a row is at most that with the centre plus the query's length times the distance.

Blocks are held in groups and queries in chunks; a group meets a chunk in one task, after a first
round that scores each query against its own group to start with a good k-th score.  Only pairs
whose group-wide bound reaches some query's k-th score are dealt out; their partial results hold at
most k rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, ordered_stage, stage, with_rank

SCALE = 256
BLOCK = 64           # rows of a block
GROUP = 8192         # rows of a group of blocks
CHUNK = 512          # queries of a chunk
PAIRS = 2            # pairs of a group and a chunk in a task, which holds them at once
PIVOTS = 128         # bounded sample that orders the rows; any order gives the same results
SAFE = 1 << 52       # inner products up to here are exact in doubles
MOST = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` (array<long>); rows without an id or with a null or non-finite component are left out."""
    x = F.col(vec_col)
    usable = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    big = float((1 << 63) - 1024)  # the largest double below 2**63
    return vectors.where(usable).select(
        F.col(id_col).alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.greatest(F.lit(-big), F.least(F.lit(big), c.cast("double") * scale)))).alias("v"))


def _matrix(rows: list[list[int]], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


class BlockIndex:
    """Blocks of consecutive rows: ids, forward index and term maxima and minima."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, block: int):
        self.ids, self.weights = ids, weights
        self.cuts = np.arange(0, len(ids), block)
        self.ends = np.append(self.cuts[1:], len(ids))
        self.high = np.maximum.reduceat(weights, self.cuts, axis=0)
        self.low = np.minimum.reduceat(weights, self.cuts, axis=0)
        real = weights.astype(np.float64)
        self.centre = np.add.reduceat(real, self.cuts, axis=0) / (self.ends - self.cuts)[:, None]
        away = np.linalg.norm(real - np.repeat(self.centre, self.ends - self.cuts, axis=0), axis=1)
        self.radius = np.maximum.reduceat(away, self.cuts)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Summed term maxima, ``[queries, blocks]``."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return _product(up, self.high) + _product(down, self.low)

    def ball_bounds(self, queries: np.ndarray) -> np.ndarray:
        """By centre and radius, ``[queries, blocks]``, in doubles and a little above the exact bound."""
        q = queries.astype(np.float64)
        length, far = np.linalg.norm(q, axis=1)[:, None], np.linalg.norm(self.centre, axis=1) + self.radius
        return q @ self.centre.T + length * self.radius + 1e-9 * length * far + 1.0


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integers, exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < SAFE:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2.0 ** 62:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)  # only what 64 bits cannot hold becomes their limit
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def search(index: BlockIndex, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, scored: list | None = None):
    """``query, vec_id, score`` of each query's best ``k`` rows of ``index`` (its own row excluded) that
    reach ``floor[query]``, block at a time; the number of blocks that each query scored is added to ``scored``."""
    bounds, balls = index.bounds(queries), index.ball_bounds(queries)
    order = np.argsort(-bounds, axis=1, kind="stable")
    for q in range(len(queries)):
        kth, best_s, best_i = floor[q], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        mine = queries[q:q + 1]
        step, at, visited = 1, 0, 0
        row = order[q]
        while at < len(row) and bounds[q, row[at]] >= kth:
            take = row[at:at + step]
            take = take[(bounds[q, take] >= kth) & (balls[q, take] >= kth)]
            at += step
            step = min(step * 2, 16)  # after the best block, a few at once
            if not len(take):
                continue
            visited += len(take)
            rows = np.concatenate([np.arange(index.cuts[b], index.ends[b]) for b in take])
            s, i = _product(index.weights[rows], mine)[:, 0], index.ids[rows]
            keep = (s >= kth) & (i != query_ids[q])
            if not keep.any():
                continue
            best_s, best_i = np.concatenate([best_s, s[keep]]), np.concatenate([best_i, i[keep]])
            top = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[top], best_i[top]
            if len(best_s) == k:
                kth = max(kth, best_s[-1])
        if scored is not None:
            scored.append(visited)
        for s, i in zip(best_s.tolist(), best_i.tolist()):
            yield int(query_ids[q]), i, s


def _pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.int64).tobytes()


def _unpack(b: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(b, dtype=np.int64).reshape(-1, dim)


def _groups(rows: DataFrame, dim: int, size: int, name: str) -> DataFrame:
    """Rows in pivot order, ``size`` at a time, as ``grp, ids, weights, high, low``."""
    def gather(it: Iterator[tuple]) -> Iterable[tuple]:
        held_id, held, grp = [], [], None

        def out():
            w = _matrix(held, dim)
            return grp, _pack(np.array(held_id)), _pack(w), _pack(w.max(axis=0)), _pack(w.min(axis=0))

        for g, i, v in it:
            if held and g != grp:
                yield out()
                held_id, held = [], []
            grp = g
            held_id.append(i)
            held.append(v)
        if held:
            yield out()

    ranked = with_rank(ordered_stage(rows.select("near", "vec_id", "v"), [F.col("near"), F.col("vec_id")], f"{name}-order"))
    cut = ranked.select(F.expr(f"_rank div {size}").alias("grp"), "_rank", "vec_id", "v")
    cut = cut.repartition("grp").sortWithinPartitions("grp", "_rank").select("grp", "vec_id", "v")
    return stage(map_rows(cut, gather, "grp long, ids binary, weights binary, high binary, low binary"), name)


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, block: int = BLOCK, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of every query (rows
    for which the column ``is_query`` over ``vec_id`` holds) with all other rows, ties to the smaller id.

    Rows without an id and vectors that are null or hold null or non-finite components take no part;
    shorter vectors count as padded with zeros; scores
    are exact wherever 64 bits hold them and the scaled components (else those are set to their limit).  A row
    is a query's own if it has its id, so of rows that repeat an id none finds another; a repeated
    query gives one result, from the vector that sorts first.  With fewer candidates than ``k`` all are
    returned; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    data = stage(quantised(vectors, id_col, vec_col, scale), "vectors")
    n, dim = data.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n or not dim:
        dim = 1  # no vectors, or all without components: every score is 0
    if not n:
        return spark.createDataFrame([], result)
    # The order of the rows: nearest of a bounded sample of pivots (the ids of smallest hash).
    pivots = _matrix([r["v"] for r in data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()], dim)
    unit = pivots / np.maximum(1.0, np.linalg.norm(pivots.astype(np.float64), axis=1, keepdims=True))
    pivot_tree = np.argsort(unit @ unit[0])  # pivots in the order of their likeness to the first

    def nearest(it: Iterator[tuple]) -> Iterable[tuple]:
        place = np.argsort(pivot_tree)
        for i, v in it:
            w = np.zeros(dim)
            w[:len(v)] = v
            yield i, v, int(place[np.argmax(unit @ w)])

    ordered = stage(map_rows(data, nearest, "vec_id long, v array<long>, near int"), "ordered")
    groups = _groups(ordered, dim, group, "blocks")
    asked = ordered.where(is_query).groupBy("vec_id").agg(F.min(F.struct("near", "v")).alias("q")).select("vec_id", "q.*")
    if asked.isEmpty():
        return spark.createDataFrame([], result)
    chunks = _groups(asked, dim, chunk, "queries")

    def run(pairs: DataFrame, floors: DataFrame | None) -> DataFrame:
        """Search the groups for the chunks they are paired with; starts from ``floors`` if given."""
        work = pairs.join(groups.select("grp", "ids", "weights"), "grp").join(
            chunks.select(F.col("grp").alias("chunk"), F.col("ids").alias("q_ids"), F.col("weights").alias("q")), "chunk")
        if floors is not None:
            work = work.join(floors, "chunk", "left")
        else:
            work = work.withColumn("floor_ids", F.lit(None).cast("array<long>")).withColumn("floor", F.lit(None).cast("array<long>"))
        work = work.select("ids", "weights", "q_ids", "q", "floor_ids", "floor").repartition(-(-pairs.count() // PAIRS) or 1)

        def rows(it: Iterator[tuple]) -> Iterable[tuple]:
            for ids, weights, q_ids, q, floor_ids, floor in it:
                index = BlockIndex(np.frombuffer(ids, dtype=np.int64), _unpack(weights, dim), block)
                q_ids = np.frombuffer(q_ids, dtype=np.int64)
                known = dict(zip(floor_ids or (), floor or ()))
                start = np.array([known.get(x, -MOST) for x in q_ids.tolist()], dtype=np.int64)
                yield from search(index, q_ids, _unpack(q, dim), start, k)

        return map_rows(work, rows, "query_id long, vec_id long, score long")

    def bounded(kth: DataFrame | None) -> DataFrame:
        """``grp, chunk, best`` of the pairs in which a group-wide bound reaches a query's k-th score; without
        k-th scores, of each chunk and list the group with the best bound for the chunk's sum.

        Small rows (term maxima of groups) meet whole chunks, never rows with rows."""
        tops = groups.select("grp", "high", "low")
        per_chunk = chunks.select(F.col("grp").alias("chunk"), "ids", "weights")
        if kth is not None:
            per_chunk = per_chunk.join(kth, "chunk", "left")
        else:
            per_chunk = per_chunk.withColumn("floor_ids", F.lit(None).cast("array<long>")).withColumn("floor", F.lit(None).cast("array<long>"))
        # lists of 256 groups are dealt to every chunk
        lists = tops.groupBy(F.expr("grp div 256").alias("list")).agg(F.collect_list(F.struct("grp", "high", "low")).alias("tops"))
        numbers = [r["list"] for r in lists.select("list").collect()]
        best_only = kth is None
        dealt = per_chunk.withColumn("list", F.explode(F.array(*[F.lit(x) for x in numbers]))).join(lists, "list")

        def rows(it: Iterator[tuple]) -> Iterable[tuple]:
            for _, c, ids, weights, floor_ids, floor, tops in it:
                q, q_ids = _unpack(weights, dim), np.frombuffer(ids, dtype=np.int64).tolist()
                known = dict(zip(floor_ids or (), floor or ()))
                start = np.array([known.get(x, -MOST) for x in q_ids], dtype=np.int64)
                high = np.concatenate([_unpack(t["high"], dim) for t in tops])
                low = np.concatenate([_unpack(t["low"], dim) for t in tops])
                bound = _product(np.maximum(q, 0), high) + _product(np.minimum(q, 0), low)
                mean = _product(q.sum(axis=0, keepdims=True), high + low)[0]
                if best_only:
                    g = max(range(len(tops)), key=lambda i: (mean[i], tops[i]["grp"]))
                    yield tops[g]["grp"], c, int(np.clip(mean[g], -MOST, MOST))
                    continue
                for g, t in enumerate(tops):
                    if (bound[:, g] >= start).any():
                        yield t["grp"], c, int(np.clip(mean[g], -MOST, MOST))

        order = ["list", "chunk", "ids", "weights", "floor_ids", "floor", "tops"]
        return map_rows(dealt.select(*order), rows, "grp long, chunk long, best long")

    pairs = stage(bounded(None), "pairs")
    first = pairs.groupBy("chunk").agg(F.max_by("grp", F.struct("best", "grp")).alias("grp")).select("grp", "chunk")
    seed = stage(run(stage(first, "first"), None), "seed")
    member = chunks.select(F.col("grp").alias("chunk"), "ids")

    def unpacked(it: Iterator[tuple]) -> Iterable[tuple]:
        for c, ids in it:
            for x in np.frombuffer(ids, dtype=np.int64).tolist():
                yield c, x

    kth = (seed.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
           .join(map_rows(member, unpacked, "chunk long, query_id long"), "query_id")
           .groupBy("chunk").agg(F.collect_list(F.struct("query_id", "kth")).alias("f"))
           .select("chunk", F.col("f.query_id").alias("floor_ids"), F.col("f.kth").alias("floor")))
    kth = stage(kth, "kth")
    rest = stage(bounded(kth).select("grp", "chunk").join(first, ["grp", "chunk"], "left_anti"), "rest")
    found = seed.unionByName(run(rest, kth)) if rest.limit(1).count() else seed
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("pos", "t")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.s")).alias("score"))
