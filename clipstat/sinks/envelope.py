"""Write a snapshot envelope: ``{channel_handle, extraction_date, total_videos, videos}``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.functions.columns import ntz

# Snapshot file name pattern of the reference (prefix + %Y%m%d_%H%M%S + .json).
SNAPSHOT_PREFIX = "youtube_videos_"
SNAPSHOT_TIME_FORMAT = "%Y%m%d_%H%M%S"
# Pages per envelope chunk: at most 50 videos per page, so a chunk is bounded.
DEFAULT_PAGES_PER_CHUNK = 1000


class EmptySnapshotError(RuntimeError):
    pass


def snapshot_name(at: dt.datetime) -> str:
    return f"{SNAPSHOT_PREFIX}{at.strftime(SNAPSHOT_TIME_FORMAT)}.json"


def iso_text(ts) -> "F.Column":
    """TIMESTAMP_NTZ -> Python ``isoformat()`` text (fraction only when non-zero)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))


SNAPSHOT_KEYS = ["channel_handle", "extraction_date"]


def build_envelopes(videos: DataFrame, order, chunk_by) -> DataFrame:
    """Envelope rows from videos ``(channel_handle, extraction_date, <order cols>,
    <8 text fields>)``; every ``(channel_handle, extraction_date)`` is one snapshot.

    A snapshot is split into chunks by ``chunk_by`` so that no envelope (one record, one
    task) grows with the extraction; each chunk carries the snapshot's ``total_videos``,
    from a pre-aggregated count (one row per snapshot) joined back.  Videos keep
    ``order`` inside a chunk.
    """
    order = list(order)
    record = F.struct(*[F.col(c) for c in schemas.VIDEO_FIELDS])
    totals = videos.groupBy(*SNAPSHOT_KEYS).agg(F.count(F.lit(1)).cast("int").alias("total_videos"))
    grouped = (videos.withColumn("_chunk", chunk_by)
                     .groupBy(*SNAPSHOT_KEYS, "_chunk")
                     .agg(F.sort_array(F.collect_list(F.struct(*order, record.alias("_v")))).alias("_vs")))
    return grouped.join(totals, SNAPSHOT_KEYS).select(
        "channel_handle",
        iso_text("extraction_date").alias("extraction_date"),
        "total_videos",
        F.transform("_vs", lambda x: x["_v"]).alias("videos"),
    )


def envelope_rows(videos: DataFrame, channel_handle: str, extraction_date: dt.datetime,
                  pages_per_chunk: int = DEFAULT_PAGES_PER_CHUNK) -> DataFrame:
    """Envelope rows of one extraction: videos ``(page_no, pos, <8 text fields>)``,
    chunked by page ranges (at most 50 videos per page)."""
    tagged = videos.select(
        F.lit(channel_handle).alias("channel_handle"),
        ntz(extraction_date).alias("extraction_date"),
        "page_no", "pos", *schemas.VIDEO_FIELDS)
    return build_envelopes(tagged, ["page_no", "pos"], F.floor(F.col("page_no") / pages_per_chunk))


def publish_envelopes(spark, envelopes: DataFrame, path: str) -> str:
    """Write envelope rows as the snapshot folder ``path``.

    The rows are written under ``path + ".tmp"`` (not a ``.json`` name, so readers skip
    it), checked for emptiness on the written files (cheap: no recomputation of the
    extraction), then renamed into place - the snapshot appears whole or not at all.
    An empty result is refused, as the reference refuses to save no data.
    """
    from clipstat.sources import fs

    tmp = path + ".tmp"
    envelopes.write.mode("errorifexists").option("ignoreNullFields", False).option("encoding", "UTF-8").json(tmp)
    if spark.read.text(tmp).isEmpty():
        fs.delete(spark, tmp)
        raise EmptySnapshotError("no video to save")
    if not fs.rename(spark, tmp, path):
        raise RuntimeError(f"could not publish snapshot {path}")
    return path


def write_snapshot(videos: DataFrame, out_dir: str, channel_handle: str,
                   extraction_date: dt.datetime, pages_per_chunk: int = DEFAULT_PAGES_PER_CHUNK) -> str:
    """Write the snapshot as ``<out_dir>/youtube_videos_<ts>.json/`` (JSON-lines parts).

    Refuses an empty dataset.  Nulls are written (``ignoreNullFields=false``) and text is
    UTF-8, unescaped.  Returns the snapshot path.
    """
    path = f"{out_dir.rstrip('/')}/{snapshot_name(extraction_date)}"
    rows = envelope_rows(videos, channel_handle, extraction_date, pages_per_chunk)
    return publish_envelopes(videos.sparkSession, rows, path)
