"""Ranked search over document tries against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from clipstat.llm import fptree, registry
from scripts.compare_oracle import canon
from tests.llm.helpers import SF, awkward, documents, load, needs_tables

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=50):
    """Rows ``(item_id, rank, doc_id, score)`` by the definition."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b, n in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    d = documents(spark, [(i, t, "en", "a") for i, t in docs], clash=True).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in fptree.rank(d, q, **options).collect()), key=repr)


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    odds = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, odds, k=rng.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("tree", [4096, 64, 7, 1])
def test_equals_plain_scores(spark, tree):
    docs = corpus(300, 1)
    docs += [(300 + i, docs[7][1]) for i in range(150)]  # a third are copies: ties go to smaller ids
    items = [(i, " ".join(f"w{(i * 7 + j * j) % 60}" for j in range(1 + i % 9))) for i in range(25)]
    assert found(spark, docs, items, tree=tree) == plain(docs, items)
    assert found(spark, docs, items, tree=tree, k=3) == plain(docs, items, 3)


def test_awkward_rows(spark):
    docs = [(i, t) for i, t, *_ in awkward()] + [(90, "İSTANBUL Straße ΑΒΓ äÖ"), (91, "straße istanbul"), (92, "a-b_c.d2"), (93, "2 2 2")]
    items = [(1, "The QUICK brown fox"), (2, None), (3, ""), (4, "!!!"), (5, "nosuchterm"), (6, "Straße İstanbul αβγ"), (6, "a b c D2 2"),
             (None, "école alpha17 fox"), (7, "word word word"), (8, "token abcdefgh12345678"), (9, "alpha0 beta7 gamma14")]
    assert found(spark, docs, items) == plain(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "a"), (1, "a")]), ([(1, "b")], [(1, "a")])])
def test_few_rows(spark, docs, items):
    assert found(spark, docs, items) == plain(docs, items)


def test_items_in_chunks_give_the_same(spark, monkeypatch):
    docs, items = corpus(80, 5), [(i, f"w{i} w{i + 1} w{i + 2}") for i in range(20)]
    monkeypatch.setattr(fptree, "ITEM_TERMS", 7)
    chunks = list(fptree.item_chunks(spark.createDataFrame([(i, t) for i, t in items], "item long, text string"), 7))
    assert len(chunks) == 10 and [i for c in chunks for i, _ in c] == list(range(20))
    assert found(spark, docs, items) == plain(docs, items)


def test_terms_of_long_texts_are_split_by_blocks(monkeypatch):
    text = " ".join(f"Wort{i % 91}-é{i % 7}" for i in range(5000)) + "x" * 3000
    whole = fptree.term_counts(text)
    monkeypatch.setattr(fptree, "BLOCK", 100)
    assert fptree.term_counts(text) == whole
    assert whole[0] == len(terms(text)) and whole[1] == Counter(t.encode() for t in terms(text))


def test_nodes_bound_what_is_below_them():
    rng = random.Random(2)
    rows = [(sorted(rng.sample(range(30), rng.randrange(1, 9)))) for _ in range(200)]
    rows = [(r, [rng.randrange(1, 6) for _ in r]) for r in rows]
    tree = fptree.Tree(list(range(200)), rows, [rng.randrange(50, 300) for _ in rows])
    seen = []

    def check(node, depth):
        lo, hi, t, tf, m, children = node
        assert m == tree.m[lo:hi].min()
        inside = {}
        for d in range(lo, hi):
            for a, b in zip(tree.terms[tree.offsets[d]:tree.offsets[d + 1]].tolist(), tree.tfs[tree.offsets[d]:tree.offsets[d + 1]].tolist()):
                inside[a] = max(inside.get(a, 0), b)
        assert dict(zip(t.tolist(), tf.tolist())) == inside
        if children:
            assert [c[0] for c in children] == [lo, *(c[1] for c in children[:-1])] and children[-1][1] == hi
            for c in children:
                check(c, depth + 1)
        else:
            seen.extend(range(lo, hi))

    check(tree.root, 0)
    assert seen == list(range(200))


def test_deep_and_equal_paths_do_not_recurse_without_end():
    rows = [(list(range(i + 1)), [1] * (i + 1)) for i in range(900)] + [([1, 2, 3], [1, 1, 1])] * 500
    tree = fptree.Tree(list(range(1400)), rows, [50] * 1400)
    searcher = fptree.Searcher([[1, 2, 3], [899]], np.full(900, 10), 5)
    searcher.add(tree)
    best = [(i, d) for i, d, _ in searcher.results()]
    # item 0: every document with all three terms scores alike, the smallest ids win; item 1: one document has the term
    assert best == [(0, 3), (0, 4), (0, 5), (0, 6), (0, 7), (1, 899)]


@needs_tables
def test_branches_are_left_out(spark):
    """On the test table an item scores few documents one by one and visits few of the nodes."""
    docs = [(r.doc_id, r.text) for r in load(spark, "documents", "/root/testdata/sf0.01").collect()]
    items = [terms(r.text) for r in load(spark, "benchmark", "/root/testdata/sf0.01").collect()]
    known = {t: i for i, t in enumerate(sorted({t for x in items for t in x}))}
    bags = [Counter(terms(t)) for _, t in docs]
    df = Counter(t for b in bags for t in b if t in known)
    order = {t: p for p, t in enumerate(sorted(known, key=lambda t: -df[t]))}
    weight = np.zeros(len(known), dtype=np.int64)
    for t, p in order.items():
        weight[p] = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
    rows = [sorted((order[t], c) for t, c in b.items() if t in known) for b in bags]
    tree = fptree.Tree([i for i, _ in docs], [([t for t, _ in r], [c for _, c in r]) for r in rows], [100] * len(docs))
    searcher = fptree.Searcher([sorted({order[t] for t in x}) for x in items], weight, 50)
    searcher.add(tree)
    assert searcher.scored < 0.6 * len(items) * len(docs), searcher.scored / len(items) / len(docs)


@needs_tables
def test_whole_table_and_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(registry.ORACLE["op13_fptree"])
    df = registry.op13_fptree(spark, SF)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in cur.description], cur.fetchall())
