"""Sharding along a Hilbert curve over several metadata dimensions.

Dimensions: source, language and the logarithm of the size.  Text dimensions are quantised by equal
depth: distinct values in code-point order, nulls last, each in the cell its first row would have if
the table were cut into ``2**bits`` equal runs by that value, so a common value spreads the others
over the cells that are left.  Sizes are quantised on a fixed logarithmic scale.  Rows are sorted by
curve index, then doc_id (nulls last), then text checksum, and cut into ``shards`` runs whose row
counts differ by one at most.  Neighbours on the curve agree in all dimensions at once, so a shard
covers a small box of each and a filter on any of them skips most shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat.llm.common import ROW_KEY, ordered_stage, quoted, with_rank, with_row_key
from clipstat.llm.hilbert import hilbert_index

SHARDS = 40
BITS = 8


def size_cell(size: Column, bits: int = BITS) -> Column:
    """Cell of a size: ``2**bits / 32`` cells for each doubling, up to 2**32."""
    return F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.greatest(size, F.lit(1))) * ((1 << bits) // 32))).cast("int")


def value_cells(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """``_value, _cell`` of every distinct value of ``column``: rows with smaller values x cells / rows."""
    counts = rows.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    ordered = ordered_stage(counts, [F.col("_value").asc_nulls_last()], "values")
    # the values of one range are summed up in it; one total for each range goes through the driver
    sums, before = [], 0
    for part, n in sorted(ordered.groupBy("_part").agg(F.sum("_n")).collect()):
        sums.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(sums, "_part int, _before long")

    def running(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_pos")
        part["_below"] = part["_n"].cumsum() - part["_n"] + part["_before"]
        return part[["_value", "_below"]]

    below = ordered.join(F.broadcast(starts), "_part").groupBy("_part").applyInPandas(running, "_value string, _below long")
    return below.select("_value", F.floor(F.col("_below") * (1 << bits) / F.lit(max(before, 1))).cast("int").alias("_cell"))


@F.pandas_udf(T.LongType())
def _curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a.to_numpy(), b.to_numpy(), c.to_numpy()], 1), BITS))


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, str] = ("source", "lang")) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve`` of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16; ``law`` is ``rows`` (shards differ by one
    row at most); ``slot`` counts from 0 in each shard.  Null metadata sorts last and is a value like any
    other; rows that tie on every key take neighbouring slots; repeated rows stay repeated; an empty
    table gives an empty result; other columns are ignored.  Texts of any length are read once and never move.
    """
    return _placed(docs, shards, dims)


def _placed(docs: DataFrame, shards: int, dims: tuple[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of :func:`shard`, and the columns ``keep``."""
    a, b = dims
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, "doc_id", F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                       text_crc32(F.col("text")).alias("text_crc32"))
    # Joins on a value that holds a third of the rows: the cells are one row for each distinct value,
    # and Spark splits the skewed side.
    for column in ("_a", "_b"):
        cells = value_cells(docs.select(F.col(a if column == "_a" else b).cast("string").alias(column)), column)
        cells = cells.withColumnRenamed("_cell", f"{column}_cell")
        rows = rows.join(cells, rows[column].eqNullSafe(cells["_value"]), "left").drop("_value")
    rows = rows.select("_row", *keep, "doc_id", "size", "text_crc32", _curve("_a_cell", "_b_cell", size_cell(F.col("size"))).alias("curve"))
    ordered = ordered_stage(rows, [F.col("curve"), F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("_row")], "curve")
    total = ordered.count()
    numbered = with_rank(ordered).withColumn("shard", F.expr(f"cast(_rank * {shards} div {max(total, 1)} as int)"))
    first = F.expr(f"(shard * cast({max(total, 1)} as bigint) + {shards - 1}) div {shards}")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                           (F.col("_rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve", *keep)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dims: tuple[str, str] = ("source", "lang")) -> DataFrame:
    """Write ``docs`` as one folder a shard, rows in slot order, and return the manifest: for each shard
    its rows, bytes and the smallest and largest value of every dimension, by which readers skip files.

    Rows are told apart by their place in the table, so equal rows spread like all others; other columns,
    whatever their names, are written along.  Rows are ranged by shard and slot: a shard's files follow one
    another in slot order, and a task writes about as much as any other.  An empty table writes no shard.
    The shard's folders are named ``_shard=`` (longer, if a column has that name)."""
    name = "_shard"
    while name in docs.columns:
        name += "_"
    keyed = with_row_key(docs, "shards")
    placed = _placed(keyed, shards, dims, tuple(ROW_KEY)).select(*ROW_KEY, F.col("shard").alias("_llm_shard"), F.col("slot").alias("_llm_slot"))
    ranged = keyed.join(placed, ROW_KEY).repartitionByRange("_llm_shard", "_llm_slot").sortWithinPartitions("_llm_shard", "_llm_slot")
    ranged.select(*[quoted(c) for c in docs.columns], F.col("_llm_shard").alias(name)).write.partitionBy(name).parquet(path)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.IntegerType())])
    return (docs.sparkSession.read.schema(schema).parquet(path).groupBy(F.col(name).alias("shard"))
            .agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"), F.min(size).alias("min_size"), F.max(size).alias("max_size"),
                 *[f(c).alias(f"{m}_{c}") for c in dims for m, f in (("min", F.min), ("max", F.max))]))
