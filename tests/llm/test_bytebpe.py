"""Chunked byte-level BPE against the library's own encoding of whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from clipstat.llm import bytebpe, registry
from tests.llm.helpers import SF, awkward, documents, load, needs_tables


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(), special_tokens={})


def digest(ids, text):
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def found(df, **options):
    return sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.digests(df, **options).collect()), key=repr)


def want(rows, whole):
    return sorted(((i, *digest(whole.encode_ordinary(t or ""), t or "")) for i, t, *_ in rows), key=repr)


def odd_texts():
    rng = random.Random(7)
    alphabet = ["a", "b", "'", "s", "re", "ll", " ", "  ", "\n", "\t", "1", "23", ".", "!?", "é", "中", "文", " ", " ", "😀", "<|endoftext|>", "\r\n", "I'", "'ve"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    # runs longer than any overlap, and runs that end where a chunk does
    texts += ["x" * 700, " " * 700, "\n" * 333 + "y", "中" * 500, "word " + " " * 300 + "word" + "'" * 200 + "s", "a" * 64 + " b", "a" * 63 + "'re b", "9" * 200 + "z"]
    texts += [("中文，" * 40) + "a b" + "文" * 150, "no space at all,but commas" * 20, " \n \n" * 100, "ab" * 31 + " " * 3 + "cd" * 40]
    return texts


@pytest.mark.parametrize("chunk,overlap", [(32, 8), (50, 5), (64, 63), (5, 3), (4, 1), (1000, 10)])
def test_any_chunking_equals_the_whole_text(spark, whole, chunk, overlap):
    rows = [(i, t, "en", "a") for i, t in enumerate(odd_texts())]
    df = documents(spark, rows, clash=True).withColumn("a.b", F.lit(1)).repartition(3)
    assert found(df, chunk=chunk, overlap=overlap) == want(rows, whole)


def test_awkward_rows(spark, whole):
    rows = awkward()
    assert found(documents(spark, rows, clash=True)) == want(rows, whole)
    assert found(documents(spark, rows), chunk=300, overlap=40) == want(rows, whole)
    assert found(documents(spark, [])) == []


def test_very_long_runs(spark, whole):
    """A run of white space on which the library's own splitting fails, and one of letters."""
    texts = [" " * 1_000_000 + "end", "a" * 300_000 + " " + "b" * 100_000, "start" + "\n" * 200_000]
    got = {r[0]: r[1:] for r in found(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]))}
    one = whole._encode_single_piece
    ids = [one(" " * 999_999) + one(" end"), one("a" * 300_000) + one(" " + "b" * 100_000), one("start") + one("\n" * 200_000)]
    assert got == {i: digest(x, t) for i, (x, t) in enumerate(zip(ids, texts))}


def test_the_pieces_join_to_the_text(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(odd_texts())]
    pieces = bytebpe.encode(documents(spark, rows), chunk=40, overlap=9)
    back = {}
    for r in bytebpe.decode(pieces).orderBy("row", "piece").collect():
        back[r.doc_id] = back.get(r.doc_id, b"") + bytes(r.bytes)
    assert back == {i: t.encode() for i, t, *_ in rows}
    many = pieces.groupBy("row").count().where("count > 1").count()
    assert many > 20  # texts are really cut
    with pytest.raises(ValueError, match="overlap"):
        bytebpe.encode(documents(spark, rows), chunk=8, overlap=8)


def test_boundaries_inside_a_chunk_are_those_of_the_text():
    """From the first shared boundary on, a chunk cut out anywhere agrees with the text."""
    find = bytebpe.pattern()
    for text in odd_texts():
        true = set(bytebpe.boundaries(find, text, True))
        for lo in range(1, max(2, len(text) - 40), 17):
            got = [lo + p for p in bytebpe.boundaries(find, text[lo:lo + 40], lo + 40 >= len(text))]
            shared = [p for p in got if p in true and p > lo]
            if shared:
                assert [p for p in got if p >= shared[0]] == sorted(p for p in true if shared[0] <= p <= got[-1])


def test_library_and_pattern_agree_on_every_letter(whole):
    """The library's splitting and ours class every code point alike."""
    find = bytebpe.pattern()
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000] + list(range(0x3000))
    for lo in range(0, len(points), 500):
        text = "".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}\n" for c in points[lo:lo + 500] if not 0xD800 <= c < 0xE000)
        assert whole.encode_ordinary(text) == [i for m in find.findall(text) for i in whole.encode_ordinary(m)]


@needs_tables
def test_whole_table(spark, whole):
    rows = [(r.doc_id, r.text) for r in load(spark, "documents").collect()]
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.op12_bpe(spark, SF).collect()), key=repr)
    assert got == want(rows, whole)
    ids = bytebpe.encode(load(spark, "documents")).where("piece = 0 and whole").first()
    assert np.frombuffer(ids.ids, dtype="<u4").tolist() == whole.encode_ordinary(dict(rows)[ids.doc_id] or "")
