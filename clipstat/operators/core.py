"""Latest extraction, keep-newest dedupe and the derived core projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions.columns import content_type, engagement_ratio, is_short, ntz, null_safe_count
from clipstat.functions.durations import readable_to_seconds


def latest_extraction(staging: DataFrame, per: str | None = None, newest=None) -> DataFrame:
    """Rows of the newest ``extraction_date``.

    Default: one global maximum (scalar subquery), as the reference does, so only the
    newest extraction of any channel is kept.  ``per="channel_handle"`` keeps the newest
    extraction of every channel instead: a pre-aggregated max per channel joined back
    (the aggregate is one row per channel, so it is small and AQE may broadcast it).

    ``newest`` may be passed as a known value (a ``datetime``): the filter is then a
    literal that reaches the Parquet scan, and plans that use the result several times
    are identical, so Spark reuses their exchanges.
    """
    if per is None:
        if newest is None:
            value = staging.agg(F.max("extraction_date")).scalar()
        else:
            value = ntz(newest)
        return staging.where(F.col("extraction_date") == value)
    dates = staging.groupBy(F.col(per).alias("_per")).agg(F.max("extraction_date").alias("_newest"))
    return staging.join(dates, staging[per].eqNullSafe(F.col("_per")) &
                        (staging["extraction_date"] == F.col("_newest")), "left_semi")


def dedupe_newest(rows: DataFrame, key: str = "video_id",
                  order=("loaded_at", "extraction_id")) -> DataFrame:
    """Keep one row per ``key``: greatest ``loaded_at``, ties broken by greatest id.

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before the shuffle
    and a final one after it, so a hot key sends at most one row per map partition
    through the exchange.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return (rows.withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") == 1).drop("_rn"))


def core_projection(rows: DataFrame) -> DataFrame:
    """Derive the 13 core columns from deduped staging rows (seconds computed once)."""
    secs = readable_to_seconds("duration_readable")
    staged = rows.select(
        "video_id", "title", secs.alias("duration_seconds"),
        F.col("duration_readable").alias("duration_formatted"),
        null_safe_count("like_count").alias("like_count"),
        null_safe_count("view_count").alias("view_count"),
        null_safe_count("comment_count").alias("comment_count"),
        "published_at", "channel_handle", "extraction_date",
    )
    return staged.select(
        "video_id", "title", "duration_seconds", "duration_formatted",
        "like_count", "view_count", "comment_count", "published_at", "channel_handle",
        content_type("duration_seconds").alias("content_type"),
        engagement_ratio("like_count", "comment_count", "view_count").alias("engagement_ratio"),
        is_short("duration_seconds").alias("is_short"),
        "extraction_date",
    )


def transform_latest(staging: DataFrame, per: str | None = None, newest=None) -> DataFrame:
    """latest -> dedupe -> project: the rows the upsert consumes."""
    return core_projection(dedupe_newest(latest_extraction(staging, per, newest)))


def newest_extraction(staging: DataFrame):
    """The newest ``extraction_date`` as a value (one aggregate, one row)."""
    return staging.agg(F.max("extraction_date")).first()[0]
