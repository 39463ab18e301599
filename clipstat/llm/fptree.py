"""Ranked lexical search over a frequent-pattern tree of documents, by branch and bound.

Only terms of the queries (items) matter.  Each document becomes its vector of (term, tf) over these,
terms in falling order of document frequency.  Documents are range-sorted by these vectors, so documents
that share a beginning are neighbours and a node of their trie is a run of rows.  Every task builds the
tries of its rows, some thousands at a time: a node keeps the maximum tf of each term below it and the
minimum m (length part of the score), which bound the score of any document below it, as a term's part
grows with tf and falls with m.

An item walks a trie depth first, the child with the best bounds first, and leaves out nodes whose
bound is below its k-th score so far; equal bounds are followed, as a smaller id may win a tie.  The
items of a chunk walk together: a node is visited by those still alive there.  Nodes of few documents or
of equal vectors are scored document by document.  The k-th scores stay for all tries of a task, which
returns at most k rows for each item.

Statistics (number of documents, their terms, document frequencies) come from all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, small_batches, stage

K = 50
TREE = 4096            # documents of a trie
LEAF = 8               # nodes of so many documents or fewer are not split further
LEVELS = 200           # nor are nodes with so many branching nodes above them
PREFIX = 24            # first terms of a vector that decide the range order (any order is right)
BLOCK = 1 << 20        # bytes of a text that are split into terms at once
ITEM_TERMS = 1 << 18   # terms of the items that are searched together
SALTS = 16

# Fixed by the data contract: everything but these ASCII ranges belongs to a term; only A-Z is lower-cased.
_SEPARATORS = [range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)]
_TABLE = bytes(32 if any(b in r for r in _SEPARATORS) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def term_counts(text: str | None) -> tuple[int, Counter]:
    """Number of terms of a text, repeats included, and how often each occurs (as UTF-8 bytes).

    The text is split block by block, each ended at a separator, so a long text is never held as terms."""
    counts: Counter = Counter()
    if text is None:
        return 0, counts
    raw = text.encode().translate(_TABLE)
    at, n = 0, 0
    while at < len(raw):
        end = raw.find(b" ", at + BLOCK)
        words = raw[at:end if end >= 0 else len(raw)].split()
        counts.update(words)
        n += len(words)
        at = end if end >= 0 else len(raw)
    return n, counts


class Tree:
    """Trie of the documents ``rows`` (sorted lists of term numbers and their tfs), in sorted order.

    ``terms``/``tfs`` of document d stand at ``offsets[d]:offsets[d + 1]``.  A node is a run of documents
    with its children, its distinct terms, their largest tfs and its smallest m."""

    def __init__(self, ids: list, rows: list[tuple], ms: list[int]):
        order = sorted(range(len(rows)), key=lambda i: rows[i][0])
        self.ids = [ids[i] for i in order]
        self.vectors = [rows[i][0] for i in order]
        self.m = np.array([ms[i] for i in order], dtype=np.int64)
        lengths = [len(v) for v in self.vectors]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        total = int(self.offsets[-1])
        self.terms = np.fromiter((t for v in self.vectors for t in v), dtype=np.int64, count=total)
        self.tfs = np.fromiter((x for i in order for x in rows[i][1]), dtype=np.int64, count=total)
        self.root = self._node(0, len(order), 0, 0)

    def _node(self, lo: int, hi: int, depth: int, level: int) -> tuple:
        """``(lo, hi, terms, largest tfs, smallest m, children)`` of the documents ``lo`` to ``hi``, which
        share their first ``depth`` terms."""
        first, last = self.vectors[lo], self.vectors[hi - 1]
        while depth < min(len(first), len(last)) and first[depth] == last[depth]:
            depth += 1  # the rows are sorted, so what the ends share all share
        children = []
        if hi - lo > LEAF and first != last and level < LEVELS:
            at = lo
            while at < hi:
                stop, branch = at + 1, self.vectors[at][depth:depth + 1]
                while stop < hi and self.vectors[stop][depth:depth + 1] == branch:
                    stop += 1
                children.append(self._node(at, stop, depth + 1, level + 1) if branch else self._leaf(at, stop))
                at = stop
        if not children:
            return self._leaf(lo, hi)
        terms, tfs = self._largest(np.concatenate([c[2] for c in children]), np.concatenate([c[3] for c in children]))
        return lo, hi, terms, tfs, min(c[4] for c in children), children

    def _leaf(self, lo: int, hi: int) -> tuple:
        span = slice(self.offsets[lo], self.offsets[hi])
        return lo, hi, *self._largest(self.terms[span], self.tfs[span]), int(self.m[lo:hi].min()), []

    @staticmethod
    def _largest(terms: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(terms):
            return terms, tfs
        order = np.argsort(terms, kind="stable")
        t = terms[order]
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        return t[starts], np.maximum.reduceat(tfs[order], starts)


class Searcher:
    """The best ``k`` documents of each item over the tries given to :meth:`add`.

    ``items``: lists of term numbers; ``weights[t]``: w of a term."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, k: int):
        self.k, self.weights = k, weights
        self.flat = np.array([t for i in items for t in i], dtype=np.int64)
        self.lengths = np.array([len(i) for i in items], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.kth = np.ones(len(items), dtype=np.int64)  # only scores above 0 count
        self.best: list[list[tuple]] = [[] for _ in items]
        self.part = np.zeros(len(weights), dtype=np.int64)
        self.visited = self.scored = 0

    def _gain(self, terms, tfs, m):
        return self.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m))

    def _sums(self, live: np.ndarray) -> np.ndarray:
        """Sum of ``part`` over the terms of each live item."""
        if len(live) * 2 > len(self.lengths):
            totals = np.concatenate([[0], np.cumsum(self.part[self.flat])])
            return (totals[self.starts + self.lengths] - totals[self.starts])[live]
        lengths = self.lengths[live]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[live] - (ends - lengths), lengths)
        totals = np.concatenate([[0], np.cumsum(self.part[self.flat[at]])])
        return totals[ends] - totals[ends - lengths]

    def _bounds(self, node, live):
        _, _, terms, tfs, m, _ = node
        self.part[terms] = self._gain(terms, tfs, m)
        out = self._sums(live)
        self.part[terms] = 0
        return out

    def add(self, tree: Tree) -> None:
        everyone = np.arange(len(self.lengths))
        if not len(everyone):
            return
        stack = [(tree.root, everyone, self._bounds(tree.root, everyone))]
        while stack:
            node, live, bounds = stack.pop()
            live = live[bounds >= self.kth[live]]  # k-th scores may have risen since
            if not len(live):
                continue
            self.visited += 1
            lo, hi, _, _, _, children = node
            if not children:
                for d in range(lo, hi):
                    self._score(tree, d, live)
                continue
            coming = []
            for child in children:
                b = self._bounds(child, live)
                keep = b >= self.kth[live]
                if keep.any():
                    coming.append((int(b[keep].sum()), len(coming), (child, live[keep], b[keep])))
            stack.extend(c[2] for c in sorted(coming, key=lambda c: c[:2]))  # the best is taken first

    def _score(self, tree: Tree, d: int, live: np.ndarray) -> None:
        span = slice(tree.offsets[d], tree.offsets[d + 1])
        terms = tree.terms[span]
        self.part[terms] = self._gain(terms, tree.tfs[span], int(tree.m[d]))
        scores = self._sums(live)
        self.part[terms] = 0
        self.scored += len(live)
        for at in np.flatnonzero(scores >= self.kth[live]).tolist():
            i = int(live[at])
            best = self.best[i]
            best.append((int(scores[at]), tree.ids[d]))
            if len(best) >= 2 * self.k or (len(best) >= self.k and self.kth[i] == 1):
                self._cut(i)

    def _cut(self, i: int) -> None:
        """Keep the best k of item i: highest scores, then smallest ids, null ids last."""
        best = sorted(self.best[i], key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:self.k]
        self.best[i] = best
        if len(best) == self.k:
            self.kth[i] = max(self.kth[i], best[-1][0])

    def results(self) -> Iterable[tuple]:
        for i in range(len(self.best)):
            self._cut(i)
            for s, doc in self.best[i]:
                yield i, doc, s


def item_chunks(items: DataFrame, limit: int = ITEM_TERMS) -> Iterator[list[tuple]]:
    """``(number, terms)`` of the items, in chunks of at most ``limit`` terms (a longer item alone), so that the
    driver and a task hold one chunk; read through a cursor, partition by partition."""
    chunk, held = [], 0
    for row in items.select("item", "text").toLocalIterator():
        terms = sorted(term_counts(row["text"])[1])
        if chunk and held + len(terms) > limit:
            yield chunk
            chunk, held = [], 0
        if terms:
            chunk.append((row["item"], terms))
            held += len(terms)
    if chunk:
        yield chunk


def rank(docs: DataFrame, items: DataFrame, k: int = K, tree: int = TREE) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` documents of highest score above 0 (all, if fewer),
    equal scores by ascending doc_id, null ids last.

    Documents without a term (null and empty texts among them) count in no statistic; items without a
    term get no rows.  Repeated rows are documents of their own, repeated items get results of their own
    with the same ``item_id``.  Other columns are ignored; an empty table gives an empty result.
    A document's terms are 64-bit counts, its text is split block by block."""
    spark = docs.sparkSession
    small_batches(spark)
    doc_type, item_type = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    numbered = stage(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "rank-items")
    found = None
    for chunk in item_chunks(numbered):
        part = _search(docs, chunk, k, tree, doc_type)
        found = part if found is None else found.unionByName(part)
    result = f"item_id {item_type}, rank int, doc_id {doc_type}, score long"
    if found is None:
        return spark.createDataFrame([], result)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]

    def best(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)

    # tasks times k rows may be many for an item: cut them salted first
    few = best(found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)).cast("int")), "item", "salt")
    return best(few.drop("rank"), "item").join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, chunk: list[tuple], k: int, size: int, doc_type: str) -> DataFrame:
    """``item, doc_id, score``: at most k rows for each item and task."""
    spark = docs.sparkSession
    known = sorted({t for _, terms in chunk for t in terms})  # at most ITEM_TERMS, or one item's
    number = {t: i for i, t in enumerate(known)}

    def vectors(rows: Iterator[tuple]) -> Iterable[tuple]:
        for doc_id, text in rows:
            n, counts = term_counts(text)
            if n:
                mine = sorted((number[t], c) for t, c in counts.items() if t in number)
                yield doc_id, n, [t for t, _ in mine], [c for _, c in mine]

    kept = stage(map_rows(docs.select("doc_id", "text"), vectors, f"doc_id {doc_type}, n long, terms array<int>, tfs array<long>"), "rank-vectors")
    n_docs, n_terms = kept.agg(F.count(F.lit(1)), F.sum(F.col("n").cast("decimal(38,0)"))).first()
    if not n_docs:
        return spark.createDataFrame([], f"item long, doc_id {doc_type}, score long")
    n_terms = int(n_terms)
    counted = kept.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # one row a term of the chunk
    df = np.zeros(len(known), dtype=np.int64)
    for t, c in counted:
        df[t] = c
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    place = np.empty(len(known), dtype=np.int64)  # terms by falling document frequency
    place[np.argsort(-df, kind="stable")] = np.arange(len(known))
    by_place = np.empty_like(weights)
    by_place[place] = weights
    item_ids = [i for i, _ in chunk]
    asked = [sorted(int(place[number[t]]) for t in terms) for _, terms in chunk]

    def paths(rows: Iterator[tuple]) -> Iterable[tuple]:
        for doc_id, n, terms, tfs in rows:
            if terms:
                at = place[np.array(terms, dtype=np.int64)]
                order = np.argsort(at, kind="stable")
                path = at[order]
                m = 50 + (50 * n * n_docs) // n_terms
                yield (path[:PREFIX].astype(">u4").tobytes(), doc_id, m, path.astype("<u4").tobytes(),
                       np.array(tfs, dtype="<i8")[order].tobytes())

    pathed = map_rows(kept, paths, f"key binary, doc_id {doc_type}, m long, path binary, tfs binary")
    # the last keys let a range boundary fall inside documents of equal vectors
    keys = ["key", F.xxhash64("path", "tfs", "doc_id"), "doc_id"]
    ranged = pathed.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def search(rows: Iterator[tuple]) -> Iterable[tuple]:
        searcher = Searcher(asked, by_place, k)
        ids, held, ms = [], [], []
        for doc_id, m, path, tfs in rows:
            ids.append(doc_id)
            ms.append(m)
            held.append((np.frombuffer(path, dtype="<u4").tolist(), np.frombuffer(tfs, dtype="<i8").tolist()))
            if len(held) == size:
                searcher.add(Tree(ids, held, ms))
                ids, held, ms = [], [], []
        if held:
            searcher.add(Tree(ids, held, ms))
        for i, doc_id, s in searcher.results():
            yield item_ids[i], doc_id, s

    return map_rows(ranged.select("doc_id", "m", "path", "tfs"), search, f"item long, doc_id {doc_type}, score long")
