"""The pipeline stage by stage, and the queries of the subpackage."""

import os
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from clipstat.llm import credentials, mixing, packing, registry, simhash
from tests.llm.helpers import SF, awkward, documents, load, needs_tables
from tests.llm.test_simhash import expected


@needs_tables
def test_stages_one_by_one(spark, tmp_dir):
    docs = load(spark, "documents")
    names, kept = docs.columns, []
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = step(spark, docs, SF)
        docs.write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
        if i < 4:
            assert docs.columns == names
        kept.append(docs)
    before = load(spark, "documents").collect()
    langs = {r["doc_id"]: r["text"] for r in kept[0].collect()}
    assert {r["doc_id"] for r in before if r["text"] and any(map(str.isalpha, r["text"]))} >= set(langs)
    assert len(langs) > 0.98 * len(before)  # clean documents stay
    unique = {r["doc_id"]: r["text"] for r in kept[1].collect()}
    groups = expected(sorted(langs.items()))
    assert set(unique) == {d for d, _, c in groups if d == c}
    masked = {r["doc_id"]: r["text"] for r in kept[2].collect()}
    assert set(masked) == set(unique)
    for doc_id, text in masked.items():
        if text != unique[doc_id]:
            assert credentials.MASK in text and credentials.candidates(unique[doc_id])
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(kept[2]).collect() if r["taken"]}
    times = {}
    for r in kept[3].collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r["text"] == masked[r["doc_id"]]
    assert times == taken
    encode = packing.encoder()
    got = {}
    for r in kept[4].collect():
        assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r["ids"]))
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {d: n * (len(encode(masked[d])) + 1) for d, n in times.items()}


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in ([], awkward(500)):
        docs = documents(spark, rows, clash=True)
        for i, (_, step) in enumerate(corpus_pipeline.STAGES):
            out = step(spark, docs, SF)
            if i < 4:
                assert out.columns == docs.columns
            assert out.count() >= 0


def test_near_copies_leave_one_document(spark):
    text = " ".join(f"word{i * 37 % 211}" for i in range(600))
    rows = [(i, text, "en", "a") for i in range(5)] + [(9, text + " one more", "en", "b"), (20, "Some other text of its own entirely", "en", "b")]
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows), SF)
    near = (simhash.simhash(rows[0][1].encode()) ^ simhash.simhash(rows[5][1].encode())) & ((1 << 64) - 1)
    assert {r["doc_id"] for r in kept.collect()} == ({0, 20} if near.bit_count() <= 3 else {0, 9, 20})


def test_every_operator_has_a_query():
    names = [n for n in registry.QUERIES if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in registry.QUERIES
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(registry.ORACLE[name])
    cols = [d[0] for d in cur.description]
    df = registry.QUERIES[name](spark, SF)
    assert df.columns == cols
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())
