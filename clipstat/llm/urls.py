"""URL filter by a character language-model ratio, behind explicit allow and block rules.

A rule is ``domain/path-prefix``; it fits its host and all subdomains if the URL's path starts
with the rule's path, and the longest fitting rule wins (of equal length: the first by text).
URLs that a rule judges also serve as labelled text: two variable-order Markov models over code
points, one of allowed and one of blocked URLs, judge every other URL.

Model: for each URL and each order 0..``order`` the contexts and the pairs (context, next character) are
counted for each class, URL end included, every one under a 64-bit hash of its own.  Counts cover every
labelled URL outside the calibration fold and are a Spark table that grows with the corpus; each chunk of
URLs to be scored asks it once for every n-gram it holds, so no n-gram is hot and no process holds the
table.  Smoothing is recursive: the probability
after the longest context is mixed with that after the next shorter one, down to a uniform
distribution, ``p_k = (n(ctx, c) + alpha * p_{k-1}) / (n(ctx) + alpha)``, so every prediction uses
as much context as has been seen.

Filter: (log-likelihood accepted - rejected) / (characters + 1).  A logistic curve fitted to the
scores of the calibration fold (labelled URLs whose crc32 modulo 5 is 0) turns it into a
probability; ``threshold`` or more is allowed.  If a class has no URL, the score is 0 and the
probability that of the classes' shares in the fold (0.5 without any).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat.llm.common import map_rows, stage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 5
CHUNK_URLS, CHUNK_CHARS = 4096, 1 << 18  # of URLs that are scored together
ALPHA = 2.0
BINS = 400          # of the calibration histogram
SCORE_RANGE = 4.0   # scores are clipped to +- this for calibration
ALPHABET = 1 << 16  # of the uniform distribution; the same for both classes
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The winning rule and its verdict (both null if none fits)."""
    text = verdict = None
    for kind, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        domain, slash, tail = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + tail)
        text = F.when(fits, rule) if text is None else text.when(fits, rule)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (text, verdict) if text is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def context_cells(urls: list[str], order: int, cells: int | None = None):
    """Cells of (context, character) and of the context alone, for every character of every URL and
    every order: two arrays ``[order + 1, characters]``, and the URL that each character is in.
    Without ``cells`` these are 64-bit hashes, else their rests."""
    start = np.uint64(0x110001)
    codes, owner = [], []
    for i, url in enumerate(urls):
        c = np.frombuffer((url or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        codes.append(np.concatenate([np.full(order, start), c, np.array([0x110002], dtype=np.uint64)]))
        owner.append(np.full(len(c) + 1, i))
    flat = np.concatenate(codes)
    lengths = np.array([len(c) for c in codes])
    first = np.cumsum(lengths) - lengths
    owner = np.concatenate(owner)
    own = np.bincount(owner, minlength=len(urls))
    at = np.arange(len(owner)) + np.repeat(first + order - (np.cumsum(own) - own), own)
    pair, ctx = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), dtype=np.uint64)
        for k in range(order + 1):
            if k:
                h = (h * _STEP + flat[at - k]) * _MIX
                h ^= h >> np.uint64(32)
            seed = np.uint64(k + 1)
            c = (h ^ seed) * _MIX
            p = ((h ^ seed) * _STEP + flat[at]) * _MIX
            ctx.append((c ^ (c >> np.uint64(29))) * _MIX)
            pair.append((p ^ (p >> np.uint64(29))) * _MIX)
    pair, ctx = np.stack(pair), np.stack(ctx)
    if cells:
        pair, ctx = (pair >> np.uint64(32)) % np.uint64(cells), (ctx >> np.uint64(32)) % np.uint64(cells)
    return pair.view(np.int64), ctx.view(np.int64), owner


def _keys(urls: list[str], order: int, cells: int | None):
    """Keys in the table of counts of pairs and of contexts ``[2, order + 1, characters]``, and each character's URL."""
    pair, ctx, owner = context_cells(urls, order, cells)
    keys = np.stack([pair, ctx])
    if cells:  # each kind and order has cells of its own
        keys = keys + cells * np.arange(2 * (order + 1)).reshape(2, order + 1, 1)
    return keys, owner


def chunked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_chunk``, staged: at most ``CHUNK_URLS`` neighbouring rows and, but for the last row, ``CHUNK_CHARS`` characters."""
    at = rows.columns.index("url")

    def dealt(it: Iterator[tuple]) -> Iterable[tuple]:
        chunk = n = chars = 0
        for *row, part in it:
            if n >= CHUNK_URLS or chars >= CHUNK_CHARS:
                chunk, n, chars = chunk + 1, 0, 0
            n, chars = n + 1, chars + len(row[at] or "")
            yield (*row, (part << 33) + chunk)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return stage(map_rows(rows.withColumn("_part", F.spark_partition_id()), dealt, f"{schema}, _chunk long"), "urls")


def count_ngrams(labelled: DataFrame, order: int, cells: int | None) -> DataFrame:
    """``key, rejected, accepted``: how often the URLs of each class (``url, cls``) hold each pair and context."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for cls, name in ((0, "rejected"), (1, "accepted")):
                urls = frame["url"][frame["cls"] == cls].tolist()
                for lo in range(0, len(urls), 512):
                    key, n = np.unique(_keys(urls[lo:lo + 512], order, cells)[0], return_counts=True)
                    yield pd.DataFrame({"key": key, "rejected": 0, "accepted": 0} | {name: n})

    found = labelled.select("url", "cls").mapInPandas(count, "key long, rejected long, accepted long")
    return found.groupBy("key").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted"))


@dataclass
class RatioModel:
    """Counts of n-grams (:func:`count_ngrams`) and the calibration."""
    counts: DataFrame
    order: int
    cells: int | None
    alpha: float
    slope: float = 0.0
    offset: float = 0.0
    usable: bool = True

    def scored(self, chunks: DataFrame) -> DataFrame:
        """``chunks`` (from :func:`chunked`) with ``score``."""
        if not self.usable:
            return chunks.withColumn("score", F.lit(0.0))
        order, cells, alpha = self.order, self.cells, self.alpha

        def asked(left: pa.Table) -> pa.Table:
            key = np.unique(_keys(left["url"].to_pylist(), order, cells)[0])
            return pa.table({"_chunk": pa.array(np.full(len(key), left["_chunk"][0].as_py())), "key": key})

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            urls = left["url"].to_pylist()
            keys, owner = _keys(urls, order, cells)
            known = right["key"].to_numpy()
            by_key = np.argsort(known)
            known = np.append(known[by_key], 0)  # the last stands for n-grams that no labelled URL holds
            at = np.searchsorted(known[:-1], keys)
            at[known[at] != keys] = len(known) - 1
            logp = []
            for cls in ("rejected", "accepted"):
                n = np.append(right[cls].to_numpy()[by_key], 0)[at]
                p = np.full(len(owner), 1.0 / ALPHABET)
                for k in range(order + 1):
                    p = (n[0, k] + alpha * p) / (n[1, k] + alpha)
                logp.append(np.bincount(owner, weights=np.log(np.minimum(p, 1.0)), minlength=len(urls)))
            return left.append_column("score", pa.array((logp[1] - logp[0]) / np.bincount(owner, minlength=len(urls))))

        wanted = chunks.select("_chunk", "url").groupBy("_chunk").applyInArrow(asked, "_chunk long, key long")
        found = wanted.join(self.counts, "key")
        schema = T.StructType([*chunks.schema.fields, T.StructField("score", T.DoubleType())])
        return chunks.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(score, schema)

    def scores(self, urls: list[str]) -> np.ndarray:
        """Scores of a few URLs."""
        if not urls:
            return np.zeros(0)
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(urls)), "row long, url string")
        return np.array([r["score"] for r in sorted(self.scored(chunked(rows)).select("row", "score").collect())])

    def calibrate(self, held: DataFrame) -> None:
        """Fit the logistic curve to ``score, cls`` rows; at most 4 * BINS + 2 rows reach the driver."""
        clipped = F.greatest(F.lit(-SCORE_RANGE), F.least(F.lit(SCORE_RANGE), F.col("score")))
        hist = held.groupBy(F.rint(clipped * (BINS / SCORE_RANGE)).cast("long").alias("bin"), "cls").agg(F.count("*").alias("n")).toPandas()
        points = hist.pivot_table(index="bin", columns="cls", values="n", fill_value=0) if len(hist) else pd.DataFrame()
        good, bad = (points.get(c, pd.Series(0, index=points.index)).to_numpy(dtype=float) for c in (1, 0))
        self.slope, self.offset = fit_logistic(points.index.to_numpy(dtype=float) * SCORE_RANGE / BINS, good, bad)

    def probability(self, score: np.ndarray) -> np.ndarray:
        return logistic(score, self.slope, self.offset)


def logistic(score, slope: float, offset: float):
    z = slope * np.clip(score, -SCORE_RANGE, SCORE_RANGE) + offset
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(score: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through weighted points (Newton, slightly ridged so
    that separable folds keep a finite slope)."""
    a = b = 0.0
    n = good + bad
    if good.sum() == 0 or bad.sum() == 0:
        share = (good.sum() + 1) / (n.sum() + 2) if n.sum() else 0.5
        return 0.0, math.log(share / (1 - share))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -500, 500)))
        g = np.array([np.sum((good - n * p) * score) - 1e-2 * a, np.sum(good - n * p) - 1e-6 * b])
        w = n * p * (1 - p)
        h = np.array([[np.sum(w * score * score) + 1e-2, np.sum(w * score)], [np.sum(w * score), np.sum(w) + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 10.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def in_fold() -> Column:
    return (F.crc32(F.col("url").cast("binary")) % 5) == 0


def _counted(labelled: DataFrame, order: int, cells: int | None, alpha: float) -> RatioModel:
    """Model without calibration from ``url, cls`` rows."""
    training = labelled.where(~in_fold())
    classes = training.groupBy("cls").count().count()
    return RatioModel(count_ngrams(training, order, cells), order, cells, alpha, usable=classes == 2)


def fit(labelled: DataFrame, order: int = ORDER, cells: int | None = None, alpha: float = ALPHA) -> RatioModel:
    """Model from ``url, accepted`` rows.  ``cells`` bounds the cells of each order; without it every n-gram
    has its own."""
    rows = chunked(labelled.select("url", F.col("accepted").cast("int").alias("cls")))
    model = _counted(rows, order, cells, alpha)
    model.calibrate(model.scored(rows.where(in_fold())))
    return model


def judge(pages: DataFrame, rules=RULES, threshold: float = 0.5, order: int = ORDER, cells: int | None = None,
          alpha: float = ALPHA) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, p_allow`` of every row of ``pages``.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are judged by
    the model on their text (null: empty).  Repeated rows stay repeated and get the same verdict;
    an empty table gives an empty result; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    ruled = chunked(parsed.select("*", rule.alias("rule"), kind.alias("kind"), F.when(kind.isNotNull(), (kind == "allow").cast("int")).alias("cls")))
    model = _counted(ruled.where("cls is not null"), order, cells, alpha)
    judged = stage(model.scored(ruled), "url-scores")
    model.calibrate(judged.where("cls is not null").where(in_fold()))
    slope, offset = model.slope, model.offset

    @F.pandas_udf("double")
    def probability(score: pd.Series) -> pd.Series:
        return logistic(score, slope, offset)

    judged = judged.withColumn("p_allow", probability("score"))
    by_model = F.when(F.col("p_allow") >= threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("kind", by_model).alias("verdict"), "score", "p_allow")
