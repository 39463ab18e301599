"""SimHash near-dedup by a binary trie self-join over 64-bit fingerprints.

Fingerprint: lower-case A-Z, words are runs of non-white-space (ASCII), every run of
``shingle`` consecutive words (repeats included) is joined by single spaces and hashed with
XXH64 (UTF-8, seed 42); a bit is 1 if it is set in more than half of the hashes.  A text of
fewer words is one shingle; a text without words has fingerprint zero and is linked like any
other.

Self-join: fingerprints that differ in at most ``max_bits`` bits are linked.  A binary trie
holds the distinct fingerprints; pairs of its nodes are traversed together from (root, root),
each pair carries the number of differing bits so far and is dropped as soon as that number
exceeds the budget.  To deal the trie out, the 64 bits are cut into ``max_bits + 1`` bands.
A pair within the budget agrees on one band entirely, so with that band rotated to the front it
lies under one single node whose path has no error: each band gives one trie, each of its nodes
below the first band is the root of a traversal of its own, and a fingerprint is dealt out only
``max_bits + 1`` times.  A subtree with more than ``node_limit`` fingerprints is dealt out
further as pairs of its descendants (8 bits a step, pruned by the same budget).

Only a spanning forest of the links leaves a task, so a group of thousands of near copies does
not become all its pairs.  Components are found by star contraction over these edges.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import ROW_KEY, map_rows, quoted, stage, with_row_key

SEED = 42
LEAF_PAIRS = 16          # node pairs with at most so many fingerprint pairs are compared directly
FRONTIER = 1 << 19       # node pairs expanded at once; more are put aside on a stack
CHUNK = 1 << 19          # fingerprints whose subtrees are traversed together in a task

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = (np.arange(8) * 256).astype(np.int64)


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a whole UTF-8 text (null: empty)."""
    words = (text or b"").lower().split()  # bytes: lower() changes A-Z only, split() is ASCII white space
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size + 1) - 1
        start = end - size
        hashes = [digest(joined[a:b], SEED)
                  for a, b in zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    h = np.array(hashes, dtype=np.uint64)
    seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BITS).ravel() * 2 > len(h)  # bit 8 * byte + bit, little-endian
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of every row of ``docs``, and its long columns ``keep``."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for doc_id, text, *kept in it:
            yield doc_id, simhash(text, shingle), *kept

    schema = ", ".join(["doc_id long, fp long", *(f"{c} long" for c in keep)])
    return map_rows(docs.select("doc_id", "text", *keep), rows, schema, as_bytes=("text",))


# ---- trie traversal inside a task -------------------------------------------------------------
def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the classes of ``i[k]`` and ``j[k]``; ``label`` always holds class minima."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def _cross(alo, ahi, blo, bhi):
    """All index pairs of small ranges, as two arrays, and the row each pair came from."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return alo[row] + k // nb[row], blo[row] + k % nb[row], row


def trie_links(code: np.ndarray, roots: np.ndarray, first_bit: np.ndarray, max_bits: int) -> np.ndarray:
    """Class label (smallest index) of each fingerprint after linking all pairs found below
    ``roots``: rows ``alo, ahi, blo, bhi, errors`` of node ranges in ``code`` (uint64; each range
    sorted), whose paths end before bit ``first_bit`` (0 is the highest)."""
    label = np.arange(len(code))
    ones: dict[int, np.ndarray] = {}

    def split(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((code >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int64)])
        return hi - (ones[bit][hi] - ones[bit][lo])  # within a node zeros come before ones

    work = [(int(b), roots[first_bit == b]) for b in np.unique(first_bit)]
    while work:
        bit, f = work.pop()
        if len(f) > FRONTIER:
            half = len(f) // 2
            work += [(bit, f[:half]), (bit, f[half:])]
            continue
        alo, ahi, blo, bhi, err = f.T
        same = alo == blo
        alive = (ahi > alo) & (bhi > blo) & ~(same & (ahi - alo < 2))
        f, same = f[alive], same[alive]
        if not len(f):
            continue
        alo, ahi, blo, bhi, err = f.T
        leaf = ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS) | (bit == 64)
        if leaf.any():
            i, j, row = _cross(alo[leaf], ahi[leaf], blo[leaf], bhi[leaf])
            near = (i < j) | ~same[leaf][row]
            i, j = i[near], j[near]
            near = np.bitwise_count(code[i] ^ code[j]) <= max_bits
            label = _merge(label, i[near], j[near])
            f, same = f[~leaf], same[~leaf]
            if not len(f):
                continue
            alo, ahi, blo, bhi, err = f.T
        am, bm = split(alo, ahi, bit), split(blo, bhi, bit)
        spare = err < max_bits
        other = spare & ~same
        work.append((bit + 1, np.concatenate([
            np.stack([alo, am, blo, bm, err], 1),
            np.stack([am, ahi, bm, bhi, err], 1),
            np.stack([alo, am, bm, bhi, err + 1], 1)[spare],
            np.stack([am, ahi, blo, bm, err + 1], 1)[other]])))
    return label


def _links_of(task: np.ndarray, side: np.ndarray, first: np.ndarray, fp: np.ndarray, code: np.ndarray,
              max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of whole tasks: rows sorted here by task, side and rotated fingerprint."""
    order = np.lexsort((code, side, task))
    task, side, first, fp, code = task[order], side[order], first[order], fp[order], code[order]
    cut = np.flatnonzero(np.concatenate([[True], (task[1:] != task[:-1]) | (side[1:] != side[:-1])]))
    end = np.append(cut[1:], len(task))
    is_a = side[cut] == 0
    a, a_end = cut[is_a], end[is_a]
    pair = (np.append(task[cut][1:], -1) == task[cut])[is_a]  # its other side follows
    b, b_end = a.copy(), a_end.copy()
    if pair.any():
        b_rows = np.flatnonzero(~is_a)
        b[pair], b_end[pair] = cut[b_rows], end[b_rows]
    bits = first[a]
    err = np.where(pair, np.bitwise_count((code[a] ^ code[b]) >> (64 - bits).astype(np.uint64)), 0).astype(np.int64)
    label = trie_links(code, np.stack([a, a_end, b, b_end, err], 1), bits, max_bits)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return fp[moved], fp[label[moved]]


def _rotated(fp, band, width):
    """``fp`` with its ``band`` of ``width`` bits turned to the front (a column)."""
    k = band * width
    return F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k)) if k else fp


def _tasks(nodes: DataFrame, max_bits: int, node_limit: int) -> DataFrame:
    """``task, side, first, code, fp``: which fingerprints meet in which pair of trie nodes.

    Nodes above ``node_limit`` are met as pairs of their descendants, 8 bits deeper each round: a join of the
    pairs that are left with the children of their nodes, which drops those beyond the error budget.  Nodes
    and pairs are tables; nothing about them passes through the driver.
    """
    bands = max_bits + 1
    width = 64 // bands
    dealt = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), _rotated(F.col("fp"), b, width).alias("code")) for b in range(bands)
    ])).alias("r")).select("fp", "r.*")

    def at(depth):
        return dealt.withColumn("node", F.shiftrightunsigned("code", 64 - depth) if depth < 64 else F.col("code"))

    keyed = at(width)
    big = stage(keyed.groupBy("band", "node").count().where(F.col("count") > node_limit).select("band", "node"), "trie-big")
    root = [F.xxhash64("band", "node").alias("task"), F.lit(0).alias("side"), F.lit(width).alias("first"), "code", "fp"]
    if big.isEmpty():
        return keyed.select(*root)
    out = keyed.join(big, ["band", "node"], "left_anti").select(*root)
    pairs = big.select("band", F.col("node").alias("p"), F.col("node").alias("q"), F.lit(0).alias("errors"))
    depth = width
    while not pairs.isEmpty():
        step = min(8, 64 - depth)
        parents = pairs.select("band", F.col("p").alias("node")).union(pairs.select("band", "q")).distinct()
        deeper = F.shiftrightunsigned("code", 64 - depth - step) if depth + step < 64 else F.col("code")
        kids = stage(at(depth).join(parents, ["band", "node"], "left_semi").groupBy("band", "node", deeper.alias("child")).count(), "trie-nodes")
        depth += step
        side = lambda parent, child, n: kids.select("band", F.col("node").alias(parent), F.col("child").alias(child), F.col("count").alias(n))
        differ = F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit((1 << step) - 1)))
        met = (pairs.join(side("p", "x", "n_x"), ["band", "p"]).join(side("q", "y", "n_y"), ["band", "q"])
               .where((F.col("p") != F.col("q")) | (F.col("x") <= F.col("y")))
               .withColumn("errors", F.col("errors") + differ).where(F.col("errors") <= max_bits))
        load = F.col("n_x") + F.when(F.col("x") != F.col("y"), F.col("n_y")).otherwise(0)
        met = stage(met.select("band", F.col("x").alias("p"), F.col("y").alias("q"), "errors",
                               ((load <= node_limit) | (F.lit(depth) == 64)).alias("small")), "trie-pairs")
        # numbers of small pairs: the depth above the row's number
        number = F.lit(depth << 56).bitwiseOR(F.monotonically_increasing_id())
        numbered = met.where("small").withColumn("task", number)  # before the pair becomes two rows
        sides = numbered.select("band", "task", "p", F.explode(F.array_distinct(F.array("p", "q"))).alias("node")).select(
            "band", "node", "task", F.when(F.col("node") == F.col("p"), 0).otherwise(1).alias("side"))
        out = out.unionByName(at(depth).join(sides, ["band", "node"]).select("task", "side", F.lit(depth).alias("first"), "code", "fp"))
        pairs = met.where("not small").drop("small")
    return out


def trie_self_join(nodes: DataFrame, max_bits: int = 3, node_limit: int = 1 << 17) -> DataFrame:
    """Forest edges ``a, b`` that connect exactly the distinct fingerprints ``nodes.fp`` that
    chains of at most ``max_bits`` differing bits connect."""
    tasks = _tasks(nodes, max_bits, node_limit)
    dealt = tasks.repartition("task").sortWithinPartitions("task")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(held: pd.DataFrame) -> pd.DataFrame:
            a, b = _links_of(held["task"].to_numpy(), held["side"].to_numpy(), held["first"].to_numpy().astype(np.int64),
                             held["fp"].to_numpy(), held["code"].to_numpy().view(np.uint64), max_bits)
            return pd.DataFrame({"a": a, "b": b})

        held: list[pd.DataFrame] = []
        n = 0
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n >= CHUNK:  # all tasks but the last, which may go on
                both = pd.concat(held, ignore_index=True)
                last = both["task"].to_numpy() == both["task"].iloc[-1]
                if not last.all():
                    yield links(both[~last])
                    both = both[last].reset_index(drop=True)
                held, n = [both], len(both)
        if n:
            yield links(pd.concat(held, ignore_index=True))

    return dealt.mapInPandas(run, "a long, b long")


def star_components(edges: DataFrame) -> DataFrame:
    """``v, root``: the smallest vertex connected with each vertex that has an edge.

    Alternating large-star and small-star steps; each step is one grouped minimum and one join
    (its two sides come from Spark's own exchanges, so that skewed vertices are split), and the
    edges of each round are staged in the shared folder.
    """
    def norm(df):  # larger end first
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stage(norm(edges), "edges")
    before = state(edges)
    while before[0]:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = norm(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stage(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = stage(norm(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())


def _classes(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, cls, component_id``: the class of each fingerprint (named by one of its fingerprints) and the smallest
    doc_id of the class."""
    nodes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = star_components(trie_self_join(nodes.select("fp"), max_bits))
    linked = roots.join(nodes.withColumnRenamed("fp", "v"), "v")
    least = linked.groupBy("root").agg(F.min("rep").alias("comp"))
    linked = stage(linked.join(least, "root").select(F.col("v").alias("fp"), "root", "comp"), "linked")
    return nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("cls"), F.coalesce("comp", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    ``component_id`` is the smallest doc_id that a chain of links reaches, the row's own included.
    Null or wordless texts have fingerprint zero; a text of any length is one row in one task.  Rows with a
    null doc_id take part in the links; they get the component of the rows they reach, null if none of
    these has an id.  Repeated rows stay repeated.  An empty table gives an empty result.  Other columns
    are ignored.
    """
    fps = stage(fingerprints(docs, shingle), "simhash")
    return fps.join(_classes(fps, max_bits).drop("cls"), "fp").select("doc_id", "fp", "component_id")


def hex64(col):
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one with the smallest doc_id, of
    several with this id the one of least fingerprint, then any one.

    Rows are told apart by their place in the table, so texts that share a doc_id without being near
    copies all stay, and rows without an id (which come after those with one) lose their near copies like
    others.  Null, empty and wordless texts have fingerprint zero and are one component.  Repeated rows are copies.
    Texts of any length are compared whole; an empty table gives an empty result; other columns, whatever
    their names, pass through."""
    keyed = with_row_key(docs, "dedup")
    fps = stage(fingerprints(keyed, shingle, tuple(ROW_KEY)), "simhash")
    first = fps.join(_classes(fps, max_bits), "fp").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", *ROW_KEY)).alias("first"))
    kept = stage(first.select(*[F.col(f"first.{c}").alias(c) for c in ROW_KEY]), "kept")
    # the keys grow with the table: never broadcast, and the same plan at every size
    return keyed.join(kept.hint("merge"), ROW_KEY, "left_semi").select(*[quoted(c) for c in docs.columns])
