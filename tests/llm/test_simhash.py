"""SimHash fingerprints and components against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from clipstat.llm import simhash
from tests.llm.helpers import awkward, documents, load, needs_tables


def plain_simhash(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits=3):
    """Smallest index reachable, over all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def partition(pairs):
    groups = {}
    for key, label in pairs:
        groups.setdefault(label, set()).add(key)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def clustered(seed, n):
    """Fingerprints in chains and clumps around few centres, some a bit beyond the budget."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 40])):
            out.add(x)
            for _ in range(rng.choice([1, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
    return sorted(out)[:n]


@pytest.mark.parametrize("limit", [1 << 17, 20, 2])
@pytest.mark.parametrize("max_bits", [3, 1])
def test_trie_self_join_equals_all_pairs(spark, limit, max_bits):
    fps = clustered(limit + max_bits, 400)
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    edges = simhash.trie_self_join(nodes, max_bits, node_limit=limit)
    roots = {r["v"]: r["root"] for r in simhash.star_components(edges).collect()}
    got = partition([(signed(x), roots.get(signed(x), signed(x))) for x in fps])
    want = partition(list(zip([signed(x) for x in fps], plain_components(fps, max_bits))))
    assert got == want
    for a, b in edges.collect():
        assert a != b


def test_small_frontier_and_leaves_give_the_same(monkeypatch):
    code = np.array(clustered(9, 300), dtype=np.uint64)
    code.sort()
    root = np.array([[0, len(code), 0, len(code), 0]])
    whole = simhash.trie_links(code, root, np.array([0]), 3)
    monkeypatch.setattr(simhash, "FRONTIER", 7)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 1)
    again = simhash.trie_links(code, root, np.array([0]), 3)
    want = plain_components([int(x) for x in code])
    assert whole.tolist() == again.tolist() == want


def test_dense_group_leaves_a_forest(spark):
    """Thousands of fingerprints within the budget of each other become one class, not all pairs."""
    rng = random.Random(3)
    fps = {signed(0xABCDEF0123456789 ^ rng.getrandbits(12)) for _ in range(6000)}
    edges = simhash.trie_self_join(spark.createDataFrame([(x,) for x in fps], "fp long"))
    assert edges.count() <= 4 * len(fps)
    assert len({r["root"] for r in simhash.star_components(edges).collect()}) == 1


@pytest.mark.parametrize("shape", ["path", "star", "none"])
def test_star_components(spark, shape):
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)], "none": []}[shape]
    got = {r["v"]: r["root"] for r in simhash.star_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {v: 0 for e in edges for v in e}


def expected(rows):
    fps = [plain_simhash(t) for _, t, *_ in rows]
    comp = plain_components(fps)
    least = {}
    for (doc_id, *_), c in zip(rows, comp):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    return sorted([(r[0], signed(f), least.get(c)) for r, f, c in zip(rows, fps, comp)], key=str)


def test_awkward_rows(spark):
    rows = awkward(3000)
    got = simhash.near_duplicates(documents(spark, rows, clash=True).repartition(3)).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected(rows)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = awkward(3000)
    docs = documents(spark, rows, clash=True)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {d for d, _, c in expected(rows) if d is not None and d == c}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 0  # the rows without an id are copies of rows with one


def words(seed, n=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))


def test_texts_that_share_an_id_stay_and_copies_without_an_id_go(spark):
    a, b, c, d = (words(i) for i in range(4))
    near = c.rsplit(" ", 1)[0] + " changed"  # within three bits of c, or else a text of its own
    rows = [(1, a, "en", "x"), (1, b, "en", "x"), (1, b, "en", "y"), (2, a, "en", "x"), (None, c, "en", "x"), (None, c, "fr", "z"),
            (None, near, "en", "x"), (None, d, "en", "x"), (3, d, "en", "x")]
    odd = documents(spark, rows, clash=True).withColumn("a.b", F.lit("kept"))
    kept = simhash.drop_near_duplicates(odd.repartition(4))
    assert kept.columns == odd.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    linked = (simhash.simhash(c.encode()) ^ simhash.simhash(near.encode())) & ((1 << 64) - 1)
    stays = [(1, a), (1, b), (3, d)]
    if linked.bit_count() <= 3:
        assert sorted(got[:3], key=str) == sorted(stays, key=str) and len(got) == 4 and got[3][1] in (c, near)
    else:
        assert got == sorted([*stays, (None, c), (None, near)], key=str)
    assert {r["a.b"] for r in kept.collect()} == {"kept"}


@needs_tables
def test_whole_table(spark):
    rows = [tuple(r) for r in load(spark, "documents").select("doc_id", "text").collect()]
    got = simhash.near_duplicates(load(spark, "documents")).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected(rows)
    assert any(r["component_id"] != r["doc_id"] for r in got)
