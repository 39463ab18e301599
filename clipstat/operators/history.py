"""Once-per-day history of the latest extraction's core rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from clipstat.functions.columns import ntz

HISTORY_VALUES = ["video_id", "like_count", "view_count", "comment_count"]


def _as_date(as_of: dt.datetime):
    return F.to_date(ntz(as_of))


def history_rows_today(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """History rows recorded on ``as_of``'s calendar day.

    When the history table carries the ``recorded_date`` partition column the filter is
    on it, so only that day's directory is read.
    """
    if "recorded_date" in history.columns:
        return history.where(F.col("recorded_date") == _as_date(as_of))
    return history.where(F.to_date("recorded_at") == _as_date(as_of))


def new_history_rows(core: DataFrame, staging: DataFrame, history: DataFrame, as_of: dt.datetime,
                     newest: dt.datetime | None = None, per: str | None = None) -> DataFrame:
    """Core rows whose ``extraction_date`` equals the newest staged one and that have no
    history row on ``as_of``'s day yet (NOT EXISTS -> left anti join; a NULL key is
    kept, as in the reference).  Output: video_id, counts, recorded_at.

    ``newest`` may be given as a literal (the pipeline knows it); the filter on core is
    then pushed to the Parquet scan, otherwise it is a scalar subquery over ``staging``.
    With ``per`` (a channel column) each channel's own newest extraction counts.
    """
    if per is not None:
        dates = staging.groupBy(F.col(per).alias("_per")).agg(F.max("extraction_date").alias("_newest"))
        current = core.join(dates, core[per].eqNullSafe(F.col("_per")) &
                            (core["extraction_date"] == F.col("_newest")), "left_semi")
    else:
        value = staging.agg(F.max("extraction_date")).scalar() if newest is None else ntz(newest)
        current = core.where(F.col("extraction_date") == value)
    candidates = current.select(*HISTORY_VALUES)
    today = history_rows_today(history, as_of).select("video_id")
    return (candidates.join(today, "video_id", "left_anti")
                      .withColumn("recorded_at", ntz(as_of)))


def today_counts(core: DataFrame, history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row: rows in core and history rows recorded on ``as_of``'s day."""
    core_rows = core.agg(F.count(F.lit(1)).alias("core_rows"))
    hist_rows = history_rows_today(history, as_of).agg(F.count(F.lit(1)).alias("history_today_rows"))
    return core_rows.select("core_rows", hist_rows.scalar().alias("history_today_rows"))


def serial_ids(rows: DataFrame, base: int, id_col: str) -> DataFrame:
    """Number ``rows`` from ``base + 1`` by partition and place in it: unique and increasing,
    with gaps, like a SERIAL.  No sort, no count, no second pass; a partition or a number of
    partitions beyond what one reservation holds fails the write.
    """
    from clipstat.sources.tables import PARTITIONS_PER_APPEND, ROWS_PER_PARTITION

    mono = F.monotonically_increasing_id()
    part = F.shiftright(mono, 33)
    place = mono.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (part < PARTITIONS_PER_APPEND) & (place < ROWS_PER_PARTITION)
    number = F.lit(base + 1) + part * ROWS_PER_PARTITION + place
    return rows.withColumn(id_col, F.when(fits, number).otherwise(
        F.raise_error(F.lit("append too large for one id reservation: repartition it")).cast("bigint")))
