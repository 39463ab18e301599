"""Packing as an exact round trip of token ids."""

import zlib

import pytest

from clipstat.llm import packing
from tests.llm.helpers import awkward, documents, load, needs_tables


def check(rows, got, length=1024):
    encode = packing.encoder(engine="tokenizers")
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append(tuple([*encode(t or ""), 0]))
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append(r)
        assert len(r["ids"]) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r["ids"]))
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and (at == length or at & (at - 1) == 0)  # no padding anywhere
    assert set(pieces) == set(want)
    for doc_id, rs in pieces.items():
        if len(want[doc_id]) == 1:
            rs = sorted(rs, key=lambda r: r["start"])
            ids = [x for r in rs for x in r["ids"]]
            assert tuple(ids) == want[doc_id][0]
            assert all(r["doc_tokens"] == len(ids) for r in rs)
            assert [r["start"] for r in rs] == [sum(x["length"] for x in rs[:k]) for k in range(len(rs))]
        else:
            assert sum(r["length"] for r in rs) == sum(map(len, want[doc_id]))
    assert sum(r["length"] for r in got) == sum(len(x) for v in want.values() for x in v)


@pytest.mark.parametrize("length", [1024, 64, 1])
def test_awkward_rows(spark, length):
    rows = awkward(4000) + [(50, "a <|endoftext|> b", "en", "a")]
    check(rows, packing.pack(documents(spark, rows, clash=True).repartition(3), length=length).collect(), length)


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0


@pytest.mark.parametrize("left", range(0, 70))
def test_tail_is_cut_into_powers_of_two(left):
    cut = packing.plan_lengths(left, 1024)
    assert sum(cut) == left and all(x & (x - 1) == 0 for x in cut)


def test_equal_vocabulary_is_neighbouring():
    a, b, c = "the cat sat on the mat " * 20, "the mat sat on the cat " * 20, "été école élève là " * 20
    x, y, z = packing.curve_key([a, b, c])
    assert x == y != z


def test_empty_texts_have_a_key():
    assert packing.curve_key(["", None, " "]).tolist() == [packing.curve_key([""])[0]] * 3
    assert len(packing.curve_key([])) == 0


@pytest.mark.parametrize("text", ["a <|endoftext|> b<|endoftext|>", "<|endoftext|>", "a" + " " * 1_000_000 + "b", "\n" * 1_000_000,
                                  "a" + " \t\u3000" * 4000 + "b", "<|endoftext", ""])
def test_ids_are_those_of_a_plain_tokenizers_call(spark, text):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(public.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert list(packing.encoder()(text)) == want == list(packing.encoder(engine="tokenizers")(text))
    got = sorted(packing.pack(documents(spark, [(1, text, "en", "a")])).collect(), key=lambda r: r["start"])
    assert [x for r in got for x in r["ids"]] == [*want, packing.END_ID]
    assert all(r["doc_tokens"] == len(want) + 1 for r in got)


@needs_tables
def test_whole_table_and_both_engines(spark):
    docs = load(spark, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(rows, packing.pack(docs).collect())
    one, two = packing.encoder(), packing.encoder(engine="tokenizers")
    assert all(one(t or "") == two(t or "") for _, t in rows)
