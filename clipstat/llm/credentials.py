"""Secret scan with corpus-wide ownership frequency.

Base detectors (fixed by the contract): ``assign`` (a keyword, ``:`` or ``=``, a value of 8 or more
characters), ``access`` (``AKIA`` key ids of 16 or more) and ``hex`` (runs of 32 or more), each
leftmost and non-overlapping by kind over the whole text.  ``token`` adds what no pattern names: a
run of 20 or more key characters that mixes upper case, lower case and digits, looks random
(``min_entropy`` bits a character) and overlaps no base span.

Ownership: the hash of every candidate's value is counted over the corpus by distinct owners and
distinct repositories that hold it.  A value that ``example_owners`` or more owners, or
``example_repos`` or more repositories of several owners hold, is a widely copied example; any other
is owner-specific and so looks live.  Base spans stay whatever their class; a ``token`` span is
reported only if it looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, quoted, small_batches, stage

# Fixed by the contract.
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "token")  # the order of kinds at one start
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MASK = "<secret>"

_ASSIGN, _ACCESS, _HEX, _TOKEN = (re.compile(p) for p in (ASSIGN, r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}", TOKEN))


def entropy(value: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str | None, min_entropy: float = 3.5) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, value`` (code points, end exclusive) of base and token spans of a whole text."""
    text = text or ""
    found = [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    # greedy runs: the ones long enough are the same with or without the shorter ones
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    base = sorted((s, e) for _, s, e, _ in found)
    at = reach = 0
    for m in _TOKEN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        v = m[0]
        if (reach <= m.start() and any(map(str.isdigit, v)) and not (v.islower() or v.isupper())
                and any(map(str.islower, v)) and any(map(str.isupper, v)) and entropy(v) >= min_entropy):
            found.append(("token", m.start(), m.end(), v))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _digest(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _value_hash(value: str) -> str:
    return xxhash.xxh3_128_hexdigest(value.encode())


def _repo(owner: str, repo: Column | None) -> Column:
    """The repository of a row: by default what one owner holds in one language."""
    return F.concat_ws("/", F.coalesce(F.col(owner), F.lit("")), F.coalesce(F.col("lang"), F.lit(""))) if repo is None else repo


def _example(example_owners: int, example_repos: int) -> Column:
    return (F.col("owners") >= example_owners) | ((F.col("owners") > 1) & (F.col("repos") >= example_repos))


def scan(docs: DataFrame, owner: str = "source", repo: Column | None = None, min_entropy: float = 3.5) -> DataFrame:
    """One row for each row of ``docs``: ``row, doc_id, owner, repo, found`` (an array of spans with the
    hash of their value).  A null owner is an owner of its own."""
    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for row, doc_id, who, where, text in it:
            yield row, doc_id, who, where, [
                {"kind": k, "start": s, "end": e, "value": _value_hash(v)}
                for k, s, e, v in candidates(text, min_entropy)]

    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(owner).alias("owner"),
                       _repo(owner, repo).alias("repo"), "text")
    return map_rows(read, rows, "row long, doc_id long, owner string, repo string, "
                    "found array<struct<kind:string,start:int,end:int,value:string>>")


def ownership(scanned: DataFrame) -> DataFrame:
    """``value, owners, repos`` from ``owner, repo, values``: distinct owners and repositories of each value.

    Distinct (value, owner, repo) first, with partial aggregation before each shuffle, so a value
    that sits in a third of all rows costs a row for each task and repository.  A null owner counts as one.
    """
    held = scanned.select("owner", "repo", F.explode("values").alias("value")).distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def find_secrets(docs: DataFrame, owner: str = "source", repo: Column | None = None, example_owners: int = 3,
                 example_repos: int = 8, min_entropy: float = 3.5) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, live, n_live, n_example`` of every row.

    ``spans`` joins all spans (``kind:start:end``; the base ones and live-looking tokens), ``live``
    those whose value looks live.  Null texts count as empty; repeated rows stay repeated; null ids
    stay; an empty table gives an empty result; columns other than ``doc_id, text, lang`` and the
    owner are ignored.
    """
    scanned = stage(scan(docs, owner, repo, min_entropy), "secrets")
    held = ownership(scanned.select("owner", "repo", F.col("found.value").alias("values")))
    spans = scanned.select("row", F.explode("found").alias("s")).select("row", "s.*")
    example = _example(example_owners, example_repos).alias("example")
    classed = spans.join(held, "value").select("row", F.struct("start", "end", "kind", "value", example).alias("s"))
    # only rows with spans come together again; a document's spans are bounded by its own text
    classed = classed.groupBy("row").agg(F.collect_list("s").alias("classed"))
    joined = scanned.select("row", "doc_id", "found").join(classed, "row", "left")

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for _, doc_id, _, classed in it:
            spans = sorted(((s["kind"], s["start"], s["end"], s["example"]) for s in classed or ()),
                           key=lambda s: (s[1], KINDS.index(s[0])))
            base = [s[:3] for s in spans if s[0] != "token"]
            count = Counter(k for k, _, _ in base)
            shown = [s for s in spans if s[0] != "token" or not s[3]]
            live = [s[:3] for s in spans if not s[3]]
            yield (doc_id, count["assign"], count["access"], count["hex"], hashlib.sha256(_digest(base).encode()).hexdigest(),
                   _digest([s[:3] for s in shown]), _digest(live), len(live), sum(s[3] for s in spans))

    return map_rows(joined, rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                    "spans string, live string, n_live long, n_example long")


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with the union of ``spans`` replaced, one mark for each stretch."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, owner: str = "source", repo: Column | None = None, example_owners: int = 3,
                 example_repos: int = 8, min_entropy: float = 3.5) -> DataFrame:
    """``docs`` with every live-looking span masked in ``text`` (and ``n_chars``, if there, set to the
    new length); widely copied examples stay.  No row goes.

    A null text stays null and an empty one empty; a text of any length is scanned whole; repeated rows are
    masked alike, each on its own; a null owner is an owner of its own; an empty table gives an empty result;
    other columns, whatever their names, pass through.

    Only rows that hold a candidate are staged; the values that look like examples are joined back
    to them by hash.  All other texts pass through unmoved.
    """
    small_batches(docs.sparkSession)
    names = docs.columns

    @F.pandas_udf("array<string>")
    def values(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({_value_hash(v) for *_, v in candidates(t, min_entropy)}) for t in texts], dtype=object)

    @F.pandas_udf("string")
    def masked(texts: pd.Series, examples: pd.Series) -> pd.Series:
        return pd.Series([mask(t, [(s, e) for _, s, e, v in candidates(t, min_entropy) if _value_hash(v) not in known])
                          for t, known in zip(texts, (set(x) if x is not None else set() for x in examples))], dtype=object)

    tagged = docs.withColumn("_llm_values", F.coalesce(values(F.coalesce("text", F.lit(""))), F.array().cast("array<string>")))
    plain = tagged.where(F.size("_llm_values") == 0).drop("_llm_values")
    hit = stage(tagged.where(F.size("_llm_values") > 0).withColumns({
        "_llm_row": F.monotonically_increasing_id(), "_llm_owner": F.col(owner), "_llm_repo": _repo(owner, repo)}), "secret-rows")
    held = ownership(hit.select(F.col("_llm_owner").alias("owner"), F.col("_llm_repo").alias("repo"), F.col("_llm_values").alias("values")))
    known = (hit.select("_llm_row", F.explode("_llm_values").alias("value"))
             .join(held.where(_example(example_owners, example_repos)).select("value"), "value")
             .groupBy("_llm_row").agg(F.collect_set("value").alias("_llm_examples")))
    done = hit.join(known, "_llm_row", "left").withColumn("text", masked("text", "_llm_examples"))
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return plain.select(*[quoted(c) for c in names]).unionByName(done.select(*[quoted(c) for c in names]))
