"""Packing of whole documents into token sequences along a Hilbert curve.

Each document's words are hashed into ``HASHED`` counts; the vector (square roots, unit length) is
projected to three fixed random dimensions, quantised and placed on a Hilbert curve, so documents
with the same vocabulary are near each other.  Rows are range-sorted by curve index (then doc_id) and
each range is tokenised and packed in order: documents follow one another, each ended by ``end_id``,
and are cut wherever a sequence of ``length`` tokens is full.  What is left at the end of a range is
cut into sequences whose lengths are powers of two, so that no padding is needed.

Tokens: those of ``tokenizers`` with the public ``byte_bpe_50k.json``, ``add_special_tokens=False``; an
added token of that file (``<|endoftext|>``) that a text holds gets its own id.  By default the same
vocabulary is run from its rank file by ``tiktoken``, which is about five times as fast, for texts on
which both give the same ids: those without an added token and without a run of more than ``MAX_SPACE``
white-space characters (on very long ones ``tiktoken`` fails).  All other texts, and with
``engine="tokenizers"`` all texts, go through ``tokenizers``.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat.llm.common import map_rows, small_batches
from clipstat.llm.hilbert import hilbert_index

LENGTH = 1024
END_ID = 0
HASHED = 1024
BITS = 10
DIMS = 3
SEED = 7
MAX_SPACE = 10_000  # longer runs of white space are not given to tiktoken, which overflows its stack between 700,000 and 1,000,000


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((HASHED, DIMS))


def curve_key(texts: Iterable[str | None]) -> np.ndarray:
    """Hilbert index of each text's projected hashed vector (no words: the point in the middle)."""
    matrix = _projection()
    points = []
    for text in texts:
        words = (text or "").encode().lower().split()
        at = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) % HASHED
        v = np.sqrt(np.bincount(at, minlength=HASHED))
        points.append((v / max(1.0, np.linalg.norm(v))) @ matrix)
    if not points:
        return np.zeros(0, dtype=np.int64)
    # a unit vector's projection has variance one: three deviations cover the grid
    grid = np.clip((np.array(points) + 3.0) / 6.0, 0.0, 1.0)
    return hilbert_index(np.rint(grid * ((1 << BITS) - 1)).astype(np.int64), BITS)


@F.pandas_udf(T.LongType())
def _key(texts: pd.Series) -> pd.Series:
    return pd.Series(curve_key(texts))


def encoder(path: str | None = None, engine: str = "tiktoken"):
    """A function from a text to its token ids.

    ``path`` is the JSON file with ``engine="tokenizers"``, else the rank file, beside which the JSON file
    stands under the same name.
    """
    import public_tokenizers as public

    ranked = engine != "tokenizers"
    if ranked:
        path = path or public.path("byte_bpe_50k.tiktoken")
    whole = path.removesuffix(".tiktoken") + ".json" if ranked else path or public.path("byte_bpe_50k.json")
    tok = None

    def plain(text):
        nonlocal tok
        if tok is None:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(whole)
        return tok.encode(text, add_special_tokens=False).ids

    if not ranked:
        return plain
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    with open(whole, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    # tried at the start of each run only; Python's white space includes that of both libraries
    spaces = re.compile(rf"\s(?<!\s\s)\s{{{MAX_SPACE}}}")

    def encode(text):
        unlike = any(t in text for t in added) or (len(text) > MAX_SPACE and spaces.search(text))
        return plain(text) if unlike else fast(text)

    return encode


def plan_lengths(left: int, length: int) -> list[int]:
    """Lengths of the sequences that the last ``left`` (< ``length``) tokens of a range fill: powers of two."""
    return [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, engine: str = "tiktoken",
         keep_ids: bool = True) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32`` and, with
    ``keep_ids``, the piece's ``ids``.

    ``start`` counts the document's tokens before the piece, ``offset`` the sequence's.  A null text is
    empty and still has its end token, so every row of ``docs`` yields at least one piece.  Repeated
    rows are packed as often as they occur; rows without an id are packed like others; documents of
    equal key are ordered by id and place in the table; an empty table gives an empty result; other
    columns are ignored.  A range is streamed: a worker holds one document and the sequence being filled.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    order: list[Column] = [F.col("_key"), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ranged = rows.withColumn("_key", _key("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "text", F.spark_partition_id().alias("_part"))

    def pieces(it: Iterator[tuple]) -> Iterable[tuple]:
        encode = encoder(path, engine)
        sequence, used, held = None, 0, []  # held: pieces of the sequence being filled

        def made(piece, seq, at):
            doc_id, start, ids, total = piece
            out = (doc_id, start, len(ids), total, seq, at, zlib.crc32(ids.astype("<u4").tobytes()))
            return (*out, ids.tolist()) if keep_ids else out

        def laid(pieces, seq):
            at = 0
            for piece in pieces:
                yield made(piece, seq, at)
                at += len(piece[2])

        for doc_id, text, part in it:
            if sequence is None:
                sequence = part << 40
            ids = np.array([*encode(text), end_id], dtype=np.uint32)
            start = 0
            while start < len(ids):
                piece = ids[start:start + length - used]
                held.append((doc_id, start, piece, len(ids)))
                start += len(piece)
                used += len(piece)
                if used == length:
                    yield from laid(held, sequence)
                    sequence, used, held = sequence + 1, 0, []
        for size in plan_lengths(used, length):
            now, room = [], size
            while room:
                doc_id, start, ids, total = held.pop(0)
                if len(ids) > room:
                    held.insert(0, (doc_id, start + room, ids[room:], total))
                    ids = ids[:room]
                now.append((doc_id, start, ids, total))
                room -= len(ids)
            yield from laid(now, sequence)
            sequence += 1

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long"
    return map_rows(ranged, pieces, schema + (", ids array<int>" if keep_ids else ""))
