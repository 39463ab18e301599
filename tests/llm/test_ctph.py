"""Fingerprints against a plain version, and the order of next documents."""

import hashlib

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clipstat.llm import ctph
from tests.llm.helpers import awkward, documents, load, needs_tables

ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def plain_fingerprint(data: bytes) -> str:
    """Byte by byte: rolling polynomial of the last eight bytes, mixed; chunks end at its triggers."""
    if not data:
        return "3::"
    rolled = []
    for i in range(len(data)):
        h = sum((data[i - j] + 1) * pow(0x01000193, j, 1 << 32) for j in range(min(8, i + 1))) % (1 << 32)
        h ^= h >> 15
        h = h * 0x2C1B3C6D % (1 << 32)
        rolled.append(h ^ (h >> 12))

    def cuts(k):
        size = 3 << k
        return [i + 1 for i, h in enumerate(rolled) if (h + 1) % size == 0 and h + 1 < 1 << 32]

    def letters(ends):
        ends = sorted({*ends, len(data)})
        return "".join(ABC[xxhash.xxh32_intdigest(data[a:b]) >> 26] for a, b in zip([0, *ends], ends))

    k = next(k for k in range(40) if len(cuts(k)) < 64)
    return f"{3 << k}:{letters(cuts(k))}:{letters(cuts(k + 1))}"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def plain_likeness(a, b):
    (ka, a1, a2), (kb, b1, b2) = a.split(":"), b.split(":")
    close = lambda x, y: 1 - levenshtein(x, y) / max(len(x), len(y)) if x or y else 1.0
    pairs = {1.0: [(a1, b1), (a2, b2)], 2.0: [(a1, b2)], 0.5: [(a2, b1)]}.get(int(ka) / int(kb), [])
    return max([close(*p) for p in pairs], default=0.0)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000))
def test_fingerprint_equals_plain_version(data):
    assert ctph.fingerprint(data) == plain_fingerprint(data)


def test_segments_do_not_show(monkeypatch):
    data = bytes((i * i * 31 + i // 7) % 251 for i in range(5000))
    whole = ctph.fingerprint(data)
    for size in (8, 100, 999):
        monkeypatch.setattr(ctph, "SEGMENT", size)
        assert ctph.fingerprint(data) == whole


def test_repeating_text_has_a_short_signature():
    assert len(ctph.fingerprint(b"a" * 100_000)) < 20


def plain_result(rows):
    """Every row's next in descending doc_id order (nulls last, then by text), then the contract."""
    rows = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        mine, new, other = (plain_fingerprint(t.encode()) for t in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mine, new,
                    round(plain_likeness(mine, new), 9), round(plain_likeness(mine, other), 9)))
    return sorted(out, key=str)


def compared(df):
    return sorted([(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, ctph.compare_with_edits(df).collect())], key=str)


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 7] + [(7, "long " * 3000 + "tail", "en", "a")]
    assert compared(documents(spark, rows, clash=True).repartition(3)) == plain_result(rows)


@pytest.mark.parametrize("rows", [[], [(5, "only one here", "en", "a")], [(None, "x", None, None)], [(1, "a b", None, None)] * 5])
def test_few_rows(spark, rows):
    assert compared(documents(spark, rows)) == plain_result(rows)


@needs_tables
def test_whole_table(spark):
    docs = load(spark, "documents")
    got = compared(docs)
    short = {r["doc_id"] for r in docs.where("n_chars < 1500").collect()}
    want = plain_result([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert [g for g in got if g[0] in short] == [w for w in want if w[0] in short]
    assert [g[:3] for g in got] == [w[:3] for w in want]
