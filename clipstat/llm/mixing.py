"""Mixing sources to target weights by Pareto order sampling.

Size of a document: its words.  Sources in code-point order (null last) weigh 1, 2, 3, repeating, and
share the words of the whole table; a target stops at ``max_copies`` times its source's size and the
excess is shared again by weight until none is above.

In a source with ``target / size = c + f`` (whole part c, rest f) every document is taken c times for
certain.  The words that are still missing come from a fixed-size sample with unequal probabilities:
inclusion grows with the square root of the document's size, ``p = f * sqrt(size) / m`` (m the mean
of the roots weighted by size, so that the expected words are the missing ones), and a document's
rank is the quotient of odds ``u / (1 - u) : p / (1 - p)`` with a uniform number u made from a hash of the seed
and the document.  The documents of smallest quotient are taken once more, as long as the middle
of the document in the running sum of sizes is within the missing words, so the taken words miss the
target by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import ROW_KEY, WORD, ordered_stage, quoted, stage, with_rank, with_row_key

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix-1"
EDGE = 1e-6  # inclusion probabilities are kept this far from 0 and 1, so that odds are finite


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, z, m, target`` from ``source, z (words), m``.

    Every round is one aggregate over the sources: those whose share by weight would pass their limit
    get the limit, the rest is shared again; ends when no source joins the limited ones.
    """
    ordered = ordered_stage(sizes, [F.col("source").asc_nulls_last()], "sources")
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = stage(with_rank(ordered).withColumn("w", w).select("source", "z", "m", "w"), "weights")
    dec = "decimal(38,0)"
    limit = F.col("z") * max_copies
    total, all_w = ranked.agg(F.sum(F.col("z").cast(dec)), F.sum(F.col("w").cast(dec))).first()
    level, limited = float(total or 0) / float(all_w or 1), -1
    while True:
        full = limit < F.col("w") * F.lit(level)
        n, capped, free = ranked.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, limit).cast(dec)), F.lit(0).cast(dec)),
                                     F.coalesce(F.sum(F.when(~full, F.col("w")).cast(dec)), F.lit(0).cast(dec))).first()
        if n == limited or not free:
            break
        level, limited = float(total - capped) / float(free), n
    return ranked.select("source", "z", "m", F.when(full, limit.cast("double")).otherwise(F.col("w") * F.lit(level)).alias("target"))


def uniform(doc_id: Column, size: Column, seed: str = SEED) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash of seed, document and size."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), size.cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def plan(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, source, size, source_size, target, copies``, ``_row``
    (the row's number in this reading of ``docs``) and the columns ``keep``."""
    root = F.floor(F.sqrt(F.col("size").cast("double")) * 1024).cast("long")  # whole numbers sum alike in any order
    sized = stage(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "source", words(F.col("text")).alias("size"), *keep)
                  .withColumn("root", root), "sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("z"), F.sum(F.col("size").cast("decimal(38,0)") * F.col("root")).cast("double").alias("m"))
    share = targets(by_source, weights, max_copies).withColumnRenamed("source", "_source")
    rows = sized.join(share, sized["source"].eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("z") > 0, F.col("target") / F.col("z")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(ratio).cast("int"))
    rest = F.when(F.col("z") > 0, F.col("target") - F.col("whole") * F.col("z")).otherwise(0.0)
    p = F.when(F.col("m") > 0, rest * F.col("root") / F.col("m")).otherwise(0.0)
    p = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), p))
    u = uniform(F.col("doc_id"), F.col("size"), seed)
    rows = rows.withColumn("rest", rest).withColumn("q", (u / (1 - u)) / (p / (1 - p)))
    # running sums by source in the order of q: each range sums up its own rows; the offsets are one
    # row for each source and range
    keys = [F.col("source").asc_nulls_last(), F.col("q"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("_row")]
    ordered = ordered_stage(rows.select("_row", "doc_id", "source", "size", "z", "target", "whole", "rest", "q", *keep), keys, "order")
    parts = ordered.groupBy("source", "_part").agg(F.sum("size").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), before.alias("_offset"))
    run = F.sum("size").over(Window.partitionBy("_part", "source").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1))
    summed = ordered.withColumn("_run", F.coalesce(run, F.lit(0)))
    summed = summed.join(offsets, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    more = (F.col("size") > 0) & (F.col("_offset") + F.col("_run") + F.col("size") / 2 <= F.col("rest"))
    copies = F.col("whole") + F.when((F.col("whole") < max_copies) & more, 1).otherwise(0)
    return summed.select("_row", "doc_id", "source", "size", F.col("z").alias("source_size"), "target", copies.alias("copies"), *keep)


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``; ``taken`` is the words the mix
    takes of it, repeats counted.

    Null texts have size 0 and are never needed; null sources are one source, the last; rows without an id
    share one random number for each size; rows that tie are taken in the order of doc_id and size; an
    empty table gives an empty result; other columns are ignored.
    """
    planned = plan(docs, weights, max_copies, seed)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, each exactly as often as :func:`plan` takes it (texts move once).

    Rows are told apart by their place in the table, so rows that share an id, or are equal, or have no id,
    each have copies of their own.  Null and empty texts have size 0: they come with the whole copies of their
    source (a source without words has none).  Texts of any length are only counted and passed on; an
    empty table gives an empty result; other columns, whatever their names, pass through."""
    keyed = with_row_key(docs, "mix")
    copies = plan(keyed, weights, max_copies, seed, tuple(ROW_KEY)).where("copies > 0").select(*ROW_KEY, F.col("copies").alias("_llm_copies"))
    # the keys grow with the table: never broadcast, and the same plan at every size
    taken = keyed.join(stage(copies, "copies").hint("merge"), ROW_KEY)
    each = taken.withColumn("_llm_copies", F.explode(F.sequence(F.lit(1), F.col("_llm_copies").cast("int"))))
    return each.select(*[quoted(c) for c in docs.columns])
