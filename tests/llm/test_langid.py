"""Language ID: features and learner against plain versions, held-out accuracy."""

import math
import random
import zlib

import numpy as np

from clipstat.llm import langid
from tests.llm.helpers import awkward, documents, load, needs_tables

SYLLABLES = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ein", "ver", "ung"], "zz": ["eau", "oi", "tion", "é"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))]
        rows.append((i, " ".join(words), lang, f"s{i % 3}"))
    return rows


def plain_counts(text, cells):
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    plain = f" {' '.join(plain.split())} "
    out = np.zeros(cells, dtype=int)
    for n in (1, 2, 3):
        for i in range(len(plain) - n + 1):
            h = 0
            for c in plain[i:i + n]:
                h = (h * 0x01000193 + ord(c) * 0x9E3779B1) % (1 << 32)
            m = (h ^ (h >> 15)) * 0x85EBCA6B % (1 << 32)
            out[(m >> 11) % cells] += 1
    return out


def test_counts_equal_plain_version(monkeypatch):
    text = "Été 123 là-bas, Straße! 😀 word " * 20
    want = plain_counts(text, 1 << 10)
    assert (langid.counts(text, 1 << 10) == want).all()
    monkeypatch.setattr(langid, "SLICE", 7)
    assert (langid.counts(text, 1 << 10) == want).all()


def test_ftrl_step_by_hand():
    f = langid.Ftrl(2, 3, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    f.learn(np.array([0, 2]), np.array([1.0, 2.0]), 1)
    g = np.array([[0.5, -0.5], [1.0, -1.0]])  # both classes start at one half
    assert np.allclose(f.z[[0, 2]], g) and np.allclose(f.n[[0, 2]], g * g)
    w = [-(math.copysign(abs(z) - 0.1, z)) / ((1 + abs(z)) / 0.5 + 0.2) if abs(z) > 0.1 else 0.0 for z in (0.5, 1.0)]
    assert np.allclose(f.weights()[[0, 2], 0], w) and (f.weights()[1] == 0).all()


def test_l1_leaves_weights_zero():
    f = langid.Ftrl(2, 50, l1=5.0)
    rng = np.random.default_rng(0)
    for _ in range(50):
        f.learn(rng.integers(0, 50, 5), rng.random(5), int(rng.integers(2)))
    assert (f.weights() == 0).mean() > 0.9


def test_temperature_softens_overconfident_scores():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 2000)
    s = np.zeros((2000, 2))
    right = rng.random(2000) < 0.8
    s[np.arange(2000), np.where(right, y, 1 - y)] = 10.0
    t = langid.fit_temperature(s, y)
    p = 1 / (1 + math.exp(-10.0 / t))
    assert abs(p - 0.8) < 0.03 and langid.fit_temperature(np.zeros((0, 2)), np.zeros(0)) == 1.0


def test_held_out_accuracy(spark):
    rows = corpus(600)
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, rows, clash=True).repartition(3)).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[i]["lang_pred"], la) for i, _, la, _ in rows if got[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = corpus(200)
    wrong = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 5 == 0 else la, s) for i, t, la, s in rows]
    one = sorted(tuple(r) for r in langid.identify(documents(spark, rows)).collect())
    two = sorted(tuple(r) for r in langid.identify(documents(spark, wrong)).collect())
    assert one == two


def test_awkward_rows(spark):
    rows = awkward(2000)
    got = langid.identify(documents(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0.0 for i in (3, 4, 5, 6))
    assert all(by_id[i]["lang_pred"] in ("en", "fr") for i in (1, 2, 7, 8, 9, 10, 11))


def test_a_language_a_thousand_times_smaller_keeps_its_share(spark, monkeypatch):
    drawn, stage = [], langid.stage

    def seen(df, name):
        out = stage(df, name)
        drawn.append({r["lang"]: r["count"] for r in out.groupBy("lang").count().collect()})
        return out

    monkeypatch.setattr(langid, "stage", seen)
    rows = [(f"text {i} of {lang}", lang) for lang in ("a", "b", "c", "d", "e") for i in range(4000)] + [("copied text", "f")] * 4000
    rows += [(f"text {i} of f", "f") for i in range(4000)] + [(f"rare text {i}", "rare") for i in range(4)]
    langid.learn(spark.createDataFrame(rows, "text string, lang string"), max_train=140)
    few = sum(zlib.crc32(f"rare text {i}".encode()) % 10 != 9 for i in range(4))
    assert drawn[0]["rare"] == few > 0 and sum(drawn[0].values()) == 140
    assert all(12 <= drawn[0][lang] <= 35 for lang in "abcdef"), drawn[0]


def test_three_hundred_languages_are_all_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    tongue = lambda n: [letters[n % 26] + letters[n // 26 % 26] + letters[(n * 7 + k) % 26] * 2 for k in range(3)]
    rows = [(300 * k + n, " ".join(tongue(n) * (2 + k)), f"x{n:03d}", "a") for n in range(300) for k in range(8)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(documents(spark, rows)).collect()}
    assert len(set(got.values())) == 300
    assert np.mean([got[i] == la for i, _, la, _ in rows]) > 0.9


def test_nothing_to_learn_from(spark):
    assert langid.identify(documents(spark, [])).count() == 0
    got = langid.identify(documents(spark, [(1, "text", None, "a"), (2, "more text", None, "b")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
    assert langid.keep_identified(documents(spark, [])).count() == 0


def test_filter_keeps_columns_and_clean_rows(spark):
    rows = corpus(300) + [(1000, None, "xx", "a"), (1001, "123 !!", "xx", "a")]
    docs = documents(spark, rows, clash=True)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))


@needs_tables
def test_whole_table(spark):
    docs = load(spark, "documents")
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in docs.collect() if got[r["doc_id"]]["held_out"] and r["text"]]
    assert np.mean([a == b for a, b in held]) > 0.95
