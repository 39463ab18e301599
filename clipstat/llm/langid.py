"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: counts of the 1- to 3-grams of code points of the lower-cased text (runs of anything but
letters count as one space), hashed into ``FEATURES`` cells, damped (1 + log), weighted by inverse
document frequency over all learning documents and scaled to unit length.  Learning: FTRL-proximal
with L1 and L2 penalties, one weight vector for each language.  The weights are fitted on a bounded
sample (``MAX_TRAIN`` documents at most for all languages together, those of smallest hash), in which
every language takes an equal share as far as it has documents; all languages are learned, at
``FEATURES`` numbers each.  Document frequencies and class counts cover every learning document.  Temperature: one number that divides
the scores, fitted on another bounded sample (``MAX_CALIBRATE``) by likelihood.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, stage

FEATURES = 1 << 14
GRAMS = 3
MAX_TRAIN = 4000       # bound of the labelled sample that the weights are fitted on
MAX_CALIBRATE = 1000   # bound of the labelled sample that the temperature is fitted on
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
SLICE = 1 << 20        # characters whose n-grams are hashed at once
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def counts(text: str | None, features: int = FEATURES) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text, None if it has no letter."""
    plain = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not plain:
        return None
    code = np.frombuffer(f" {plain} ".encode("utf-32-le"), dtype=np.uint32)
    total = np.zeros(features, dtype=np.int64)
    for lo in range(0, len(code), SLICE):
        c = code[lo:lo + SLICE + GRAMS - 1]  # the overlap holds the n-grams across the cut
        h = np.zeros(len(c), dtype=np.uint32)
        with np.errstate(over="ignore"):
            for n in range(1, GRAMS + 1):
                h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:] * np.uint32(0x9E3779B1)
                m = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                at = (m >> np.uint32(11)) % np.uint32(features)
                total += np.bincount(at[:min(SLICE, len(at))], minlength=features)
    return total


def features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells and unit-length TF-IDF weights of a text, None if it has no letter."""
    c = counts(text, len(idf))
    if c is None:
        return None
    at = np.flatnonzero(c)
    w = (1.0 + np.log(c[at])) * idf[at]
    return at, w / max(float(np.linalg.norm(w)), 1e-12)


def document_frequency(docs: DataFrame, features: int = FEATURES) -> tuple[np.ndarray, int]:
    """Documents that hold each cell, and documents with a letter: each task adds up its own vector and
    passes on ``features + 1`` numbers at most."""
    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        total, n = np.zeros(features, dtype=np.int64), 0
        for (text,) in it:
            c = counts(text, features)
            if c is not None:
                total += c > 0
                n += 1
        yield -1, n
        for cell in np.flatnonzero(total).tolist():
            yield cell, int(total[cell])

    summed = map_rows(docs.select("text"), rows, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r["cell"]: r["n"] for r in summed}
    n = found.pop(-1, 0)
    df = np.zeros(features)
    for cell, k in found.items():
        df[cell] = k
    return df, n


class Ftrl:
    """FTRL-proximal for softmax regression with elastic-net penalties."""

    def __init__(self, classes: int, features: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1.0
        g = x[:, None] * p
        old = self.n[at]
        new = old + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
        self.n[at] = new


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The number that scores are divided by for the best likelihood (golden section on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        s = scores / math.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    lo, hi, g = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def _sample(docs: DataFrame, size: dict[str, int], bound: int, salt: int) -> DataFrame:
    """``text, lang`` of at most ``bound`` rows by hash, as even over the languages as their sizes allow.

    ``size`` has the distinct texts of each language.  The part of the hash range that lies before a text,
    times the size of its language, is about the text's rank in its language; the lowest ranks of all
    languages are drawn, so a language with few texts keeps them however large the others are.
    Repeated texts count once.  What moves is the rows of low rank, not the corpus.
    """
    h = F.xxhash64(F.lit(salt), "text")
    sizes = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(size.items()) for x in kv]), F.col("lang"))
    place = (F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53))
    ranked = docs.withColumn("_h", h).withColumn("_at", place * sizes)
    picked = ranked.where(F.col("_at") < 1.5 * bound / len(size)).dropDuplicates(["text", "lang"])
    return picked.orderBy("_at", "_h", "lang").limit(bound).select("text", "lang")


def learn(docs: DataFrame, cells: int = FEATURES, max_train: int = MAX_TRAIN, max_calibrate: int = MAX_CALIBRATE,
          epochs: int = EPOCHS) -> dict:
    """Model from ``text, lang`` rows (both not null); a plain dict, so that it can be broadcast."""
    idf_df, n = document_frequency(docs, cells)
    idf = np.log((1.0 + n) / (1.0 + idf_df)) + 1.0
    per_lang = docs.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("text").alias("texts")).collect()
    langs = sorted(r["lang"] for r in per_lang)
    model = {"langs": langs, "idf": idf, "w": np.zeros((cells, len(langs))), "t": 1.0}
    if not langs or not n:
        return model
    size = {r["lang"]: max(1, r["texts"]) for r in per_lang}
    # the hash's upper part trains and its lower part calibrates, so no text does both
    split = (F.crc32(F.col("text").cast("binary")) % 10) == 9
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    place = {lang: i for i, lang in enumerate(langs)}

    def drawn(rows: DataFrame, bound: int, salt: int) -> list[tuple]:
        picked = stage(_sample(rows, size, bound, salt), "sample")

        def made(it: Iterator[tuple]) -> Iterable[tuple]:
            for text, lang in it:
                f = features(text, shared.value)
                if f is not None:
                    yield place[lang], f[0].astype(np.uint16 if cells <= 1 << 16 else np.uint32).tobytes(), f[1].astype(np.float32).tobytes()

        kind = np.uint16 if cells <= 1 << 16 else np.uint32
        got = map_rows(picked, made, "label int, at binary, x binary").collect()  # bounded by ``bound``
        out = [(r["label"], np.frombuffer(r["at"], dtype=kind).astype(np.int64), np.frombuffer(r["x"], dtype=np.float32).astype(np.float64)) for r in got]
        return sorted(out, key=lambda r: (r[2].sum(), r[0], len(r[1])))

    train = drawn(docs.where(~split), max_train, 1)
    model_ = Ftrl(len(langs), cells)
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            label, at, x = train[i]
            model_.learn(at, x, label)
    model["w"] = model_.weights()
    held = drawn(docs.where(split), max_calibrate, 2)
    if held:
        model["t"] = fit_temperature(np.stack([x @ model["w"][at] for _, at, x in held]), np.array([y for y, _, _ in held]))
    return model


def predict(model: dict, texts: Iterable[str | None]) -> list[tuple[str, float]]:
    """Language and calibrated probability of each text; ``und`` and 0 without letters or languages."""
    out = []
    for text in texts:
        f = features(text, model["idf"]) if model["langs"] else None
        if f is None:
            out.append(("und", 0.0))
            continue
        s = f[1] @ model["w"][f[0]] / model["t"]
        p = np.exp(s - s.max())
        p /= p.sum()
        best = int(np.argmax(p))
        out.append((model["langs"][best], float(p[best])))
    return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5 is 0 (a null id is the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5) == 0


def _predicted(docs: DataFrame, text: Column) -> tuple[DataFrame, Column]:
    learning = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = learn(learning.select("text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(shared.value, texts), columns=["lang_pred", "score"])

    return docs, guess(text)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if no labelled
    row can be learned from.  Repeated rows stay repeated; an empty table gives an empty result; columns
    other than ``doc_id, text, lang`` are ignored.
    """
    docs, guess = _predicted(docs, F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), guess.alias("_g")).select(
        "doc_id", "held_out", F.col("_g.lang_pred").alias("lang_pred"), F.col("_g.score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: no letters, or a score under ``min_score``.

    Null and empty texts have no letters and go.  Texts of any length are judged whole; repeated rows are
    judged alike and stay repeated; if no labelled row can be learned from, every row goes; an empty table
    gives an empty result; other columns, whatever their names, pass through."""
    rows, guess = _predicted(docs, F.col("text"))
    judged = rows.withColumn("_llm_guess", guess)
    return judged.where((F.col("_llm_guess.lang_pred") != "und") & (F.col("_llm_guess.score") >= min_score)).drop("_llm_guess")
