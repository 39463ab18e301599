"""Byte-level BPE of whole texts by overlapping chunks.

A text of more than ``chunk`` code points is cut into chunks that reach ``overlap`` code points into the
next one.  Each chunk is pre-tokenised on its own, in whatever task holds it.  A chunk's first
boundaries may be wrong, as it starts anywhere; but a match of the pattern depends on what follows its
start only, so from the first boundary that two neighbours share in their overlap on, they agree.
There the text is cut, and the pieces between cuts are encoded.  Neighbours that share no boundary (a
run of one kind of character longer than the overlap) are joined and pre-tokenised again as one.

A shared boundary is true if the left chunk's boundaries are.  These are true after its own cut, or after
any non-space character followed by white space, where every text has a boundary whatever precedes.

Shorter texts are one chunk and one piece and do not move.  Of the long ones the text is written once
and shuffled once, when the cuts meet their chunks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, small_batches, stage

CHUNK = 1 << 14      # code points of a chunk
OVERLAP = 1 << 9     # code points that it reads of the next
AHEAD = 2            # code points behind a match that can change it ('r may become 're)
CACHED = 200_000     # pre-tokens whose ids a worker remembers
LONGEST = 64         # longer pre-tokens are not remembered


def rank_file(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers as public

    return public.path("byte_bpe_multi_50k.tiktoken")


def pattern(text: str | None = None):
    """The compiled pattern whose matches are the pre-tokens; they cover a text without gaps."""
    import public_tokenizers as public
    import regex

    return regex.compile(text or public.PATTERN)


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    with open(rank_file(path), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(path: str | None = None):
    """A function from a pre-token to the list of its ids."""
    import public_tokenizers as public
    import tiktoken

    one = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})._encode_single_piece
    cache: dict[str, list[int]] = {}

    def encode(token: str) -> list[int]:
        ids = cache.get(token)
        if ids is None:
            ids = one(token)
            if len(token) <= LONGEST:
                if len(cache) >= CACHED:
                    cache.clear()
                cache[token] = ids
        return ids

    return encode


def piece_encoder(path: str | None = None):
    """A function from a piece (from one true boundary to another) to its ids, little-endian 32-bit.

    The last match of a piece could differ from the whole text's only behind white space, as a boundary
    inside a run of white space hides what follows; ``stop`` gives the text after the piece."""
    find, encode = pattern(), encoder(path)

    def run(text: str, stop: int | None = None) -> bytes:
        ids: list[int] = []
        if stop is None or stop >= len(text):
            for token in find.findall(text):
                ids += encode(token)
        else:
            for m in find.finditer(text):
                if m.start() >= stop:
                    break
                ids += encode(m.group())
        return np.array(ids, dtype="<u4").tobytes()

    return run


def decoder(path: str | None = None):
    """A function from ids to the bytes they stand for, joined."""
    table = {i: t for t, i in read_ranks(path).items()}
    at = table.__getitem__
    return lambda ids: b"".join(map(at, ids))


def boundaries(find, text: str, ends_text: bool) -> list[int]:
    """Starts of the matches in a chunk, without those that what follows the chunk could change."""
    last = len(text) if ends_text else len(text) - AHEAD
    return [m.start() for m in find.finditer(text) if m.start() < last]


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``row, doc_id, chunk, n, text``: each text's chunks with the number of them and their overlap."""
    def cut(rows: Iterator[tuple]) -> Iterable[tuple]:
        for row, doc_id, text in rows:
            n = -(-len(text) // chunk)
            for i in range(n):
                yield row, doc_id, i, n, text[i * chunk:(i + 1) * chunk + overlap]

    kind = long.schema["doc_id"].dataType.simpleString()
    return map_rows(long, cut, f"row long, doc_id {kind}, chunk long, n long, text string")


def _cuts(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``row, chunk, start, stop, run, alone``: the span of each chunk that its run (a piece) takes, in code
    points of the text; ``alone`` if the run is this chunk only."""
    def bounds(rows: Iterator[tuple]) -> Iterable[tuple]:
        import regex

        find, sure = pattern(), regex.compile(r"\S\s")
        for row, i, n, text in rows:
            at = boundaries(find, text, i == n - 1)
            head = [p + i * chunk for p in at if 0 < p < overlap] if i else []
            tail = [p + i * chunk for p in at if p > chunk] if i < n - 1 else []
            yield row, i, n, head, tail, i == 0 or sure.search(text, 0, chunk) is not None

    narrow = stage(map_rows(chunks.select("row", "chunk", "n", "text"), bounds,
                            "row long, chunk long, n long, head array<long>, tail array<long>, sure boolean"), "bpe-bounds")
    along = Window.partitionBy("row").orderBy("chunk")
    before, so_far = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(Window.unboundedPreceding, 0)
    shared = narrow.withColumn("cut", F.array_min(F.array_intersect("tail", F.lead("head").over(along))))
    placed = shared.withColumn("broke", F.max(F.when(F.col("cut").isNull(), F.col("chunk"))).over(before)).withColumn(
        "known", F.max(F.when(F.col("sure"), F.col("chunk"))).over(so_far)).withColumn(
        "cut", F.when(F.col("broke").isNull() | (F.col("known") > F.col("broke")), F.col("cut")))
    ran = placed.withColumn("run", F.coalesce(F.count("cut").over(before), F.lit(0))).withColumn("from", F.lag("cut").over(along))
    last = F.col("chunk") == F.col("n") - 1
    return ran.select(
        "row", "chunk", "run", F.coalesce("from", F.col("chunk") * chunk).alias("start"),
        F.coalesce("cut", F.when(~last, (F.col("chunk") + 1) * chunk), F.lit((1 << 62))).alias("stop"),
        ((F.col("from").isNotNull() | (F.col("chunk") == 0)) & (F.col("cut").isNotNull() | last)).alias("alone"))


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``row, doc_id, piece, whole, ids``: the pieces of every text in order, with their ids as little-endian
    unsigned 32-bit integers; ``whole`` says that the piece is the whole text, ``row`` tells rows apart.

    Null texts are empty; an empty text has one piece without ids.  Repeated rows and rows without an id
    are encoded like all others; other columns are ignored; an empty table gives an empty result.  A worker
    holds one text while it cuts it and else chunks of ``chunk + overlap`` code points; only chunks joined
    for want of a shared boundary are held together."""
    short, long = _pieces(docs, path, chunk, overlap)
    return short.unionByName(long)


def _pieces(docs: DataFrame, path: str | None, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """The pieces that are whole texts, and those of texts that were cut."""
    if not 0 < overlap < chunk:
        raise ValueError("the overlap has to be shorter than a chunk")
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.char_length("text") > chunk
    schema = f"row long, doc_id {kind}, piece long, whole boolean, ids binary"

    def whole(it: Iterator[tuple]) -> Iterable[tuple]:
        run = piece_encoder(path)
        for row, doc_id, text in it:
            yield row, doc_id, 0, True, run(text)

    short = map_rows(rows.where(~is_long), whole, schema)
    chunks = stage(_chunks(rows.where(is_long), chunk, overlap), "bpe-chunks")
    cut = chunks.join(_cuts(chunks, chunk, overlap), ["row", "chunk"])

    def alone(it: Iterator[tuple]) -> Iterable[tuple]:
        run = piece_encoder(path)
        for row, doc_id, piece, i, start, stop, text in it:
            lo = i * chunk
            yield row, doc_id, piece, False, run(text[start - lo:], stop - start)

    def joined(it: Iterator[tuple]) -> Iterable[tuple]:
        run, held, key = piece_encoder(path), [], None
        for row, doc_id, piece, i, start, stop, text in it:
            if held and (row, piece) != key[:2]:
                yield key[0], key[2], key[1], False, run("".join(held), end)
                held = []
            key, lo = (row, piece, doc_id), i * chunk
            if not held:
                begin = start
            # all but the last chunk end where the next begins; the last keeps what follows its cut
            held.append(text[start - lo:] if stop != lo + chunk else text[start - lo:chunk])
            end = stop - begin
        if held:
            yield key[0], key[2], key[1], False, run("".join(held), end)

    columns = ["row", "doc_id", F.col("run").alias("piece"), "chunk", "start", "stop", "text"]
    single = map_rows(cut.where("alone").select(*columns), alone, schema)
    several = cut.where("not alone").select(*columns).repartition("row", "piece").sortWithinPartitions("row", "piece", "chunk")
    return short, single.unionByName(map_rows(several, joined, schema))


def _ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, dtype="<u4").tolist()


def decode(pieces: DataFrame, path: str | None = None) -> DataFrame:
    """``row, doc_id, piece, whole, bytes``: what the ids of each piece stand for.  The bytes of a text's
    pieces, joined in order, are its UTF-8 bytes (a piece may end inside no code point)."""
    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        back = decoder(path)
        for row, doc_id, piece, whole, raw in it:
            yield row, doc_id, piece, whole, back(_ids(raw))

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return map_rows(pieces.select("row", "doc_id", "piece", "whole", "ids"), rows,
                    f"row long, doc_id {kind}, piece long, whole boolean, bytes binary")


def digests(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text (cases as in :func:`encode`): SHA-256 of
    the decimal ids joined by commas and of the bytes that the ids decode to, both streamed piece by piece.
    Pieces that are whole texts stay where they are; the others are brought together as ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        back, key = decoder(path), None
        decimal = {i: str(i) for i in read_ranks(path).values()}.__getitem__
        for row, doc_id, piece, raw in it:
            if key is None or row != key[0]:
                if key is not None:
                    yield key[1], n, ids_hash.hexdigest(), text_hash.hexdigest()
                key, n, ids_hash, text_hash = (row, doc_id), 0, hashlib.sha256(), hashlib.sha256()
            ids = _ids(raw)
            if ids:
                ids_hash.update(((b"," if n else b"") + ",".join(map(decimal, ids)).encode()))
                text_hash.update(back(ids))
                n += len(ids)
        if key is not None:
            yield key[1], n, ids_hash.hexdigest(), text_hash.hexdigest()

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    columns = ["row", "doc_id", "piece", "ids"]
    short, long = (x.select(*columns) for x in _pieces(docs, path, chunk, overlap))
    together = long.repartition("row").sortWithinPartitions("row", "piece")
    return map_rows(short, rows, schema).unionByName(map_rows(together, rows, schema))
