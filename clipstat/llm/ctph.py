"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last eight UTF-8 bytes runs through the whole text.  A chunk ends where
``rolling + 1`` is a multiple of the block size ``3 * 2**k``; each chunk's own hash gives one
base-64 letter of the signature.  ``k`` is the smallest for which the text has fewer than
``LETTERS`` chunk ends, so every signature covers the whole text, and the signature at twice the
block size is stored beside it: ``block:signature:signature-at-twice-the-block``.  Boundaries
depend on nearby bytes only, so an edit changes the letters of the chunks it touches.

Two fingerprints are compared at block sizes both hold (equal, or one twice the other) by edit
distance: likeness = 1 - distance / longer length, the best of the compatible pairs, 0 if no block
size is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows

LETTERS = 64
_ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_ROLL = 0x01000193                      # base of the rolling polynomial (modulo 2**32)
_ROLL2, _ROLL4 = pow(_ROLL, 2, 1 << 32), pow(_ROLL, 4, 1 << 32)
SEGMENT = 1 << 22                       # bytes whose rolling hashes are held at once


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last eight bytes at every position (fewer at the start), 32 bits."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint32) + np.uint32(1)
        for shift, base in ((1, _ROLL), (2, _ROLL2), (4, _ROLL4)):
            h[shift:] += np.uint32(base) * h[:-shift].copy()
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
    return h


def triggers(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which a chunk may end, and the largest ``k`` whose block size fits each."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends, levels = [], []
    for lo in range(0, len(data), SEGMENT):
        warm = min(lo, 7)  # the window reaches seven bytes back
        v = rolling(data[lo - warm:lo + SEGMENT])[warm:] + np.uint32(1)
        at = np.flatnonzero((v % np.uint32(3) == 0) & (v != 0))  # 2**32 wraps to 0: no trigger
        low = v[at]
        ends.append(at + (lo + 1))
        levels.append(np.log2((low & (~low + np.uint32(1))).astype(np.float64)).astype(np.int8))
    return np.concatenate(ends), np.concatenate(levels)


def _signature(text: bytes, ends: np.ndarray) -> str:
    cuts = [0, *ends.tolist()]
    if cuts[-1] != len(text):
        cuts.append(len(text))
    digest = xxhash.xxh32_intdigest
    return "".join([_ABC[digest(text[a:b]) >> 26] for a, b in zip(cuts, cuts[1:])])


def fingerprint(text: bytes) -> str:
    """Fingerprint of a whole UTF-8 text (empty: ``3::``)."""
    if not text:
        return "3::"
    ends, level = triggers(text)
    k = int(np.argmax(np.bincount(level, minlength=34)[::-1].cumsum()[::-1] < LETTERS))
    return f"{3 << k}:{_signature(text, ends[level >= k])}:{_signature(text, ends[level >= k + 1])}"


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns, 0 to 1; null if either is null."""
    def part(c, i):
        return F.split_part(c, F.lit(":"), F.lit(i))

    def close(x, y):
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer == 0, 1.0).otherwise(1.0 - F.levenshtein(x, y) / longer)

    ka, kb = part(a, 1).cast("long"), part(b, 1).cast("long")
    return (F.when(a == b, 1.0)
            .when(ka == kb, F.greatest(close(part(a, 2), part(b, 2)), close(part(a, 3), part(b, 3))))
            .when(ka == kb * 2, close(part(a, 2), part(b, 3)))
            .when(kb == ka * 2, close(part(a, 3), part(b, 2)))
            .when(a.isNotNull() & b.isNotNull(), 0.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row (null text: empty); repeated rows stay repeated."""
    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for doc_id, text in it:
            yield doc_id, fingerprint(text or b"")

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, fingerprint string", as_bytes=("text",))


# Ranges of doc_id into which the table is cut for next_documents, times the shuffle partitions.
RANGES = 4


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, _next``: rows in descending doc_id order (null ids last, then by text) beside
    the text of the row after; the last row's next is the first row.

    The id range is cut at approximate quantiles.  The first row of every range is also dealt to the
    range before it, so each range is sorted and walked by itself and the texts are shuffled once.
    What goes through the driver is one boundary row's key for each range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = parts * RANGES
    found = texts.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q")).first()
    cuts = sorted(set((found and found["q"]) or []))
    # range number: 0 holds the largest ids; rows without an id come last
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    above = F.size(F.filter(bounds, lambda c: F.col("doc_id") <= c))
    ranged = texts.withColumn("_r", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above))
    heads = ranged.groupBy("_r").agg(F.max("doc_id").alias("top")).orderBy("_r").collect()
    if not heads:
        return texts.withColumn("_next", F.lit(None).cast("string"))
    order = [r["_r"] for r in heads]
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    copies = spark.createDataFrame([(r["_r"], before[r["_r"]], r["top"]) for r in heads], "_r int, _to int, _top long")
    # the head of a range is one row: the first by text among those with the largest id
    first = (ranged.join(F.broadcast(copies), "_r").where(F.col("doc_id").eqNullSafe(F.col("_top")))
             .groupBy("_to").agg(F.min("text").alias("text")).select(F.col("_to").alias("_r"), F.lit(1).alias("_head"),
                                                                       F.lit(None).cast("long").alias("doc_id"), "text"))
    dealt = ranged.select("_r", F.lit(0).alias("_head"), "doc_id", "text").unionByName(first)
    return dealt.repartition(parts, "_r").sortWithinPartitions("_r", "_head", F.col("doc_id").desc_nulls_last(), "text")


def pairs(ordered: Iterator[tuple]) -> Iterator[tuple]:
    """``doc_id, text, next text`` from the rows of whole ranges in order (each ends with a head row)."""
    held = None
    for _, head, doc_id, text in ordered:
        if held is not None:
            yield held[0], held[1], text
        held = None if head else (doc_id, text)


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint of every row's text and of its edited text, and how near they are.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many (or all)
    of the next row's text in descending doc_id order.  Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.  Null texts count as empty, null ids
    come last, equal ids are ordered by text, a single row is its own next; an empty table gives an
    empty result; other columns are ignored.
    """
    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        last_text = last_print = None
        for doc_id, text, after in pairs(it):
            mine = last_print if text == last_text else fingerprint(text.encode())
            last_text, last_print = after, fingerprint(after.encode())
            half = len(text) // 2
            edited = (text[:len(text) - half] + after[:half]).encode()
            yield doc_id, len(text), hashlib.sha256(edited).hexdigest(), mine, fingerprint(edited), last_print

    ordered = with_next(docs)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    if "_r" not in ordered.columns:  # an empty table
        return docs.sparkSession.createDataFrame([], schema + ", near_edited double, near_next double").drop("next_fingerprint")
    made = map_rows(ordered, rows, schema)
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
