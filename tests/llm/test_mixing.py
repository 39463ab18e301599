"""Mixing against a plain version of targets and Pareto order sampling."""

import hashlib
import math
import re
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from clipstat.llm import mixing, registry
from tests.llm.helpers import SF, awkward, documents, load, needs_tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(z):
    """Exact: share by weight, fix what passes three times its size, share the rest again."""
    names = sorted((s for s in z if s is not None)) + ([None] if None in z else [])
    w = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(z.values()), set()
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(3 * z[s] for s in fixed)
        level = Fraction(left, sum(w[s] for s in free)) if free else 0
        over = {s for s in free if w[s] * level > 3 * z[s]}
        if not over:
            return {s: float(3 * z[s] if s in fixed else w[s] * level) for s in names}
        fixed |= over


def plain_mix(rows):
    size = [len(WORD.findall(t or "")) for _, t, *_ in rows]
    z = {}
    for (_, _, _, s), n in zip(rows, size):
        z[s] = z.get(s, 0) + n
    target = plain_targets(z)
    out = []
    for s in z:
        mine = [(r[0], n) for r, n in zip(rows, size) if r[3] == s]
        whole = math.floor(target[s] / z[s]) if z[s] else 0
        rest = target[s] - whole * z[s]
        m = sum(n * math.floor(math.sqrt(n) * 1024) for _, n in mine)
        ranked = []
        for i, n in mine:
            key = f"{mixing.SEED}:{'null' if i is None else i}:{n}"
            u = (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            p = min(1 - 1e-6, max(1e-6, rest * math.floor(math.sqrt(n) * 1024) / m if m else 0))
            ranked.append(((u / (1 - u)) / (p / (1 - p)), i is None, i or 0, n, i))
        run = 0
        for *_, n, i in sorted(ranked, key=lambda r: r[:4]):
            extra = whole < 3 and n > 0 and run + n / 2 <= rest
            run += n
            out.append((i, n, z[s], round(target[s], 6), n * (whole + extra)))
    return sorted(out, key=str)


def mixed(df):
    return sorted([(*r[:3], round(r[3], 6), r[4]) for r in map(tuple, mixing.mix(df).collect())], key=str)


def sources(n=8, docs=40):
    return [(s * 1000 + i, " ".join(["w"] * (1 + (i * 7 + s) % 50)) if s else "w", "en", f"s{s}" if s < n - 1 else None)
            for s in range(n) for i in range(docs * (3 if s == 2 else 1))]


@pytest.mark.parametrize("rows", [sources(), sources(4, 5), [(1, "one two", "en", "a")], [(i, "x " * (i % 9 + 1), "en", "Z" if i % 3 else "a") for i in range(90)]])
def test_equals_plain_version(spark, rows):
    assert mixed(documents(spark, rows, clash=True).repartition(3)) == plain_mix(rows)


def test_awkward_rows(spark):
    rows = awkward(3000)
    assert mixed(documents(spark, rows, clash=True)) == plain_mix(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a"), (2, "", None, None)]])
def test_no_words(spark, rows):
    assert [r[4] for r in mixed(documents(spark, rows))] == [0] * len(rows)


def test_laws_of_the_mix(spark):
    rows = sources(9, 200)
    got = mixing.mix(documents(spark, rows)).collect()
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-6 for r in got)
    source = {i: s for i, _, _, s in rows}
    taken, most = {}, {}
    for r in got:
        s = source[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
    for r in got:
        s = source[r["doc_id"]]
        assert abs(taken[s] - r["target"]) <= most[s] / 2 + 1e-6
    targets = {source[r["doc_id"]]: r["target"] for r in got}
    assert math.isclose(sum(targets.values()), sum(r["size"] for r in got))


def test_larger_documents_are_taken_more_often(spark):
    rows = [(i, "w " * (1 if i % 2 else 64), "en", "a" if i < 2000 else "b") for i in range(4000)]
    got = [r for r in mixing.mix(documents(spark, rows)).collect() if r["doc_id"] < 2000]
    share = {n: sum(r["taken"] > 0 for r in got if r["size"] == n) / 1000 for n in (1, 64)}
    assert share[64] > 3 * share[1] > 0


def test_documents_of_the_mix(spark):
    rows = sources(5, 30)
    docs = documents(spark, rows, clash=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["taken"]}
    assert times == want and mixing.mixed_documents(documents(spark, [])).count() == 0


def test_row_keys_tell_multiplied_rows_apart(spark, tmp_dir):
    from clipstat.llm.common import ROW_KEY, with_row_key

    spark.range(50).repartition(3).write.parquet(f"{tmp_dir}/t")
    read = spark.read.parquet(f"{tmp_dir}/t")
    twice = read.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    for df, n, staged in ((read, 50, False), (read.where("id < 20").select("id"), 20, False), (twice, 100, True), (read.join(read, "id"), 50, True),
                          (read.unionByName(read), 100, True), (spark.range(7), 7, True)):
        keyed = with_row_key(df, "keys")
        assert keyed.columns == [*df.columns, *ROW_KEY] and keyed.select(*ROW_KEY).distinct().count() == n == keyed.count()
        assert ("llm-keys" in "".join(keyed.inputFiles())) == staged
    assert sorted(map(tuple, with_row_key(read, "keys").collect())) == sorted(map(tuple, with_row_key(read, "keys").repartition(7).collect()))


@pytest.mark.parametrize("ids", [lambda i: 7, lambda i: None, lambda i: i % 3])
def test_rows_that_share_an_id_have_copies_of_their_own(spark, ids):
    rows = [(ids(i), "w " * (12 if i % 2 else 20), "en", "a" if i < 70 else "b" if i < 100 else None) for i in range(120)]
    rows += [(ids(0), None, "en", "a"), (ids(0), "", "en", "b")]
    docs = documents(spark, rows, clash=True).withColumn("a.b", F.lit("kept")).repartition(3)
    planned = mixing.mix(docs).collect()
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken, found = {}, {}
    for r in planned:
        taken[r["doc_id"], r["size"]] = taken.get((r["doc_id"], r["size"]), 0) + r["taken"]
    for r in out.collect():
        size = len((r["text"] or "").split())
        found[r["doc_id"], size] = found.get((r["doc_id"], size), 0) + size
    assert found == {k: v for k, v in taken.items() if v} | {k: v for k, v in found.items() if not v}
    assert sum(found.values()) == sum(r["taken"] for r in planned) > 0


@needs_tables
def test_whole_table_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(registry.ORACLE["op10_mixing"]).fetchall()
    got = [tuple(r) for r in mixing.mix(load(spark, "documents")).collect()]
    assert sorted(got) == sorted(want)
