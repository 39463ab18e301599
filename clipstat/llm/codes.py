"""Vector code compression: codebooks for the parts of a vector by active-entry Lloyd rounds.

Components become ``floor(scale * x)``; a vector is cut into equal consecutive parts, and each part
position has a codebook of a few entries.  A round gives every part its nearest entry and then moves
each entry to the floor of its parts' mean.

A part remembers its entry and the exact distance to it.  Of the entries that did not move since, none
can have come closer than the remembered one, so a part whose own entry stayed fixed compares only the
entries that moved; a part whose entry moved compares all.  Ties go to the lower index in both.

The rows with their codes and distances are one table in the shared folder, written anew by each round
(one pass without a shuffle) together with the partial sums of its tasks; only the sums of the entries,
whose number is fixed by the parameters, reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat.llm.common import small_batches, stage
from clipstat.session import ensure_checkpoint_dir
from clipstat.sources import fs

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SMALL = 1 << 24       # integers below it: squared distances of a part are exact in 64 bits
LIMB = 32             # partial sums travel in signed limbs of so many bits, so none overflows
CELLS = 1 << 19       # components worked on at once
SALTS = 16            # a label's sum is dealt to so many tasks


@dataclass
class Codebooks:
    """``entries[part][entry]`` is a list of integers; ``compared[round]`` counts the distances computed."""
    entries: list
    scale: int = SCALE
    compared: list = field(default_factory=list)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for p in self.entries for e in p for x in e).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """The vector that a code (two hex digits a part) stands for."""
        return [x / self.scale for p, c in enumerate(bytes.fromhex(code)) for x in self.entries[p][c]]


def _exact(v: float, scale: int) -> int:
    return int(v) * scale if v == math.floor(v) else math.floor(v * scale)


def _matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones padded with zeros."""
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(len(col), dim)
    out = np.zeros((len(col), dim))
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


def nearest(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code=None, dist=None):
    """Entry, squared distance and number of distances computed for the parts ``x`` of one position.

    ``code`` and ``dist`` are those of the round before (None: none); ``moved`` marks the entries that
    changed since."""
    def to(rows, entries):
        diff = rows[:, None, :] - book[entries][None, :, :]
        return (diff * diff).sum(axis=-1)

    n, k = len(x), len(book)
    full = np.ones(n, dtype=bool) if code is None else moved[code]
    new_code = np.zeros(n, dtype=np.int64) if code is None else code.astype(np.int64)
    new_dist = np.zeros(n, dtype=x.dtype) if dist is None else dist.copy()
    if full.any():
        d = to(x[full], np.arange(k))
        new_code[full] = d.argmin(axis=1)  # the first of equals
        new_dist[full] = d[np.arange(len(d)), new_code[full]]
    rest, entries = np.flatnonzero(~full), np.flatnonzero(moved)
    if len(rest) and len(entries):
        d = to(x[rest], entries)
        at = d.argmin(axis=1)
        best, entry = d[np.arange(len(d)), at], entries[at]
        closer = (best < new_dist[rest]) | ((best == new_dist[rest]) & (entry < new_code[rest]))
        new_code[rest[closer]], new_dist[rest[closer]] = entry[closer], best[closer]
    return new_code, new_dist, int(full.sum()) * k + len(rest) * len(entries)


def _limbs(total: list[int]):
    """``(limb, values)`` of a list of integers, lowest limb first."""
    rest, sign, k = [abs(v) for v in total], [1 if v >= 0 else -1 for v in total], 0
    while k == 0 or any(rest):
        yield k, [s * (v & ((1 << LIMB) - 1)) for s, v in zip(sign, rest)]
        rest, k = [v >> LIMB for v in rest], k + 1


def _pass(books: Codebooks, moved: np.ndarray | None, dim: int, schema: pa.Schema, last: bool):
    """The function of one round over Arrow batches of ``id, label, vec, code, dist``: yields the same
    rows with new codes and distances, and at the end the sums of its rows by part and entry."""
    entries, scale = books.entries, books.scale

    def rows(batches):
        parts, k, width = len(entries), len(entries[0]), len(entries[0][0])
        tall = any(abs(v) >= SMALL for p in entries for e in p for v in e)
        exact = [np.array(p, dtype=object).reshape(k, width) for p in entries]
        book = None if tall else [e.astype(np.int64) for e in exact]
        change = np.ones((parts, k), dtype=bool) if moved is None else moved
        sums, counts, work = {}, {}, 0

        def add(part, code, x):
            for e in np.unique(code).tolist():
                mine = x[code == e]
                counts[part, e] = counts.get((part, e), 0) + len(mine)
                s = [int(v) for v in mine.sum(axis=0)]
                sums[part, e] = [a + b for a, b in zip(sums.get((part, e), [0] * width), s)]

        for batch in batches:
            step = max(1, CELLS // dim)
            for lo in range(0, batch.num_rows, step):
                cut = batch.slice(lo, step)
                n = cut.num_rows
                real = _matrix(cut.column(2), dim)
                with np.errstate(over="ignore"):
                    whole = np.floor(real * scale)
                fast = (np.abs(whole) < SMALL).all(axis=1) & (not tall)
                old = [c is not None for c in cut.column(4).to_pylist()]
                # rows with integers too large for 64-bit distances are scanned completely, in Python integers
                known = fast & np.array(old, dtype=bool)
                code, dist = np.zeros((n, parts), dtype=np.int64), np.zeros((n, parts), dtype=object)
                small = np.zeros((n, parts), dtype=np.int64)
                if known.any():
                    pick = np.flatnonzero(known)
                    code[pick] = np.frombuffer(b"".join(cut.column(3).take(pa.array(pick)).to_pylist()), dtype=np.uint8).reshape(-1, parts)
                    small[pick] = np.frombuffer(b"".join(cut.column(4).take(pa.array(pick)).to_pylist()), dtype=np.int64).reshape(-1, parts)
                for group in (np.flatnonzero(known), np.flatnonzero(fast & ~known)):
                    if not len(group):
                        continue
                    x = whole[group].astype(np.int64).reshape(len(group), parts, width)
                    back = known[group[0]]
                    for p in range(parts):
                        c, d, did = nearest(x[:, p], book[p], change[p], code[group, p] if back else None, small[group, p] if back else None)
                        code[group, p], small[group, p], work = c, d, work + did
                        if not last:
                            add(p, c, x[:, p])
                for r in np.flatnonzero(~fast).tolist():
                    x = np.array([_exact(v, scale) for v in real[r].tolist()], dtype=object).reshape(parts, width)
                    for p in range(parts):
                        c, d, did = nearest(x[p:p + 1], exact[p], change[p])
                        code[r, p], dist[r, p], work = c[0], int(d[0]), work + did
                        if not last:
                            add(p, c, x[p:p + 1])
                codes = [row.tobytes() for row in code.astype(np.uint8)]
                if last:
                    total = [int(s.sum()) if f else sum(d) for f, s, d in zip(fast.tolist(), small, dist)]
                    yield pa.RecordBatch.from_arrays(
                        [cut.column(0).cast(schema.field(0).type), cut.column(1).cast(schema.field(1).type),
                         pa.array([c.hex() for c in codes], schema.field(2).type),
                         pa.array([t if t < 1 << 63 else None for t in total], pa.int64())], schema=schema)
                    continue
                kept = [s.tobytes() if f else None for f, s in zip(fast.tolist(), small)]
                none = [pa.nulls(n, f.type) for f in list(schema)[6:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["rows"] * n), *(cut.column(i).cast(schema.field(i + 1).type) for i in range(3)),
                     pa.array(codes, pa.binary()), pa.array(kept, pa.binary()), *none], schema=schema)
        if last:
            return
        out = [(p, e, limb, counts[p, e] if limb == 0 else 0, values) for (p, e), s in sums.items() for limb, values in _limbs(s)]
        out.append((-1, 0, 0, work, []))
        cols = [pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[6:])]
        none = [pa.nulls(len(out), f.type) for f in list(schema)[1:6]]
        yield pa.RecordBatch.from_arrays([pa.array(["sums"] * len(out)), *none, *cols], schema=schema)

    return rows


def _prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    x = F.col(vec_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    kind = vectors.schema[vec_col].dataType
    vec = x if isinstance(kind.elementType, T.FloatType) else x.cast("array<double>")
    return vectors.where(usable).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vec.alias("vec"))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of every usable vector, and the codebooks.

    Vectors that are null or hold null or non-finite components are left out.  A codebook starts as that
    part of the vectors with the ``entries`` smallest ids (null ids after all others, repeated ids in the
    order of their vectors; fewer vectors give fewer entries).  Shorter vectors count as padded with
    zeros to the longest, and all to a multiple of ``parts``.  Repeated rows each get a row.  Components
    of any size are exact; an error beyond 64 bits is null.  An empty table gives an empty result and
    codebooks without entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    spark = vectors.sparkSession
    small_batches(spark)
    data = stage(_prepared(vectors, id_col, vec_col, label_col), "codes-in")
    dim = data.agg(F.max(F.size("vec"))).first()[0]
    label = vectors.schema[label_col].dataType
    out = T.StructType([T.StructField("vec_id", vectors.schema[id_col].dataType), T.StructField("label", label),
                        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if dim is None:
        return spark.createDataFrame([], out), Codebooks([[] for _ in range(parts)], scale)
    width = max(1, -(-dim // parts))
    dim = parts * width
    first = [[_exact(v, scale) for v in r["vec"]] + [0] * (dim - len(r["vec"]))
             for r in data.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()]
    books = Codebooks([[v[p * width:(p + 1) * width] for v in first] for p in range(parts)], scale)

    from pyspark.sql.pandas.types import to_arrow_schema

    columns = [T.StructField("kind", T.StringType()), *data.schema.fields, T.StructField("code", T.BinaryType()),
               T.StructField("dist", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
               T.StructField("limb", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))]
    both = T.StructType(columns)
    rows_schema = T.StructType(columns[1:6])
    state, path, moved = data.withColumn("code", F.lit(None).cast("binary")).withColumn("dist", F.lit(None).cast("binary")), None, None
    for _ in range(rounds):
        into = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-codes-{uuid.uuid4().hex[:12]}"
        state.mapInArrow(_pass(books, moved, dim, to_arrow_schema(both), False), both).write.partitionBy("kind").parquet(into)
        if path:
            fs.delete(spark, path)  # the round before is used up
        path = into
        sums = spark.read.schema(T.StructType(columns[6:])).parquet(f"{path}/kind=sums")
        found = sums.select("part", "entry", "limb", "n", F.posexplode_outer("sums").alias("pos", "v")).groupBy("part", "entry", "limb", "pos").agg(
            F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
        total, count, work = {}, {}, 0
        for r in found:
            if r["part"] < 0:
                work += r["n"]
                continue
            at = r["part"], r["entry"]
            total.setdefault(at, [0] * width)[r["pos"]] += r["v"] << (LIMB * r["limb"])
            if r["limb"] == 0:
                count[at] = r["n"]
        new = [[[s // count[p, e] for s in total[p, e]] if (p, e) in count else old for e, old in enumerate(book)] for p, book in enumerate(books.entries)]
        moved = np.array([[a != b for a, b in zip(x, y)] for x, y in zip(new, books.entries)])
        books = Codebooks(new, scale, books.compared + [work])
        state = spark.read.schema(rows_schema).parquet(f"{path}/kind=rows")
        if not moved.any():
            break  # further rounds would change nothing
    coded = stage(state.mapInArrow(_pass(books, moved, dim, to_arrow_schema(out), True), out), "codes")
    if path:
        fs.delete(spark, path)
    return coded, books


def codes_with_errors(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; ``label_error`` sums the errors of equal
    labels (nulls together) and is null if one of them, or the sum, is beyond 64 bits.  Other cases: as
    :func:`compress`."""
    coded, books = compress(vectors)
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    totals = coded.groupBy("label").agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error")).select(
        F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt2"))
    rows = coded.withColumn("_salt", salt)
    joined = rows.join(totals, (F.col("_salt") == F.col("_salt2")) & F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
