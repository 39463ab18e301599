"""Landed API responses: channel listings, playlist pages and videos pages.

The HTTP client is outside the engine; responses are landed as JSON files and read here
with explicit schemas.  The page number comes from the file name (``..._<n>.json``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat import schemas
from clipstat.sources import fs

PAGE_NO_PATTERN = r"([0-9]+)\.json$"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
                 .option("pathGlobFilter", "*.json").json(path))


def _with_page_no(df: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return df.withColumn("page_no", F.regexp_extract(name, PAGE_NO_PATTERN, 1).cast("bigint"))


def read_playlist_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page_no, items, nextPageToken)`` from landed playlistItems responses."""
    return _with_page_no(_read(spark, path, schemas.PLAYLIST_PAGE)).select("page_no", "items", "nextPageToken")


def read_videos_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page_no, items)`` from landed videos responses."""
    return _with_page_no(_read(spark, path, schemas.VIDEOS_PAGE)).select("page_no", "items")


def read_channel_listing(spark: SparkSession, path: str) -> DataFrame:
    """Landed channels responses -> ``(handle, channel_id, uploads_playlist_id)``.

    The response does not carry the handle it answered, so files are named by handle
    (``<handle>.json``); the first item of each response is the channel, as in the
    reference.
    """
    df = _read(spark, path, schemas.CHANNELS_RESPONSE)
    first = F.get(F.col("items"), 0)
    return df.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("handle"),
        first["id"].alias("channel_id"),
        first["contentDetails"]["relatedPlaylists"]["uploads"].alias("uploads_playlist_id"),
    )


PLAYLIST = "playlist_id"
# So many playlists are named to the scan; of more, Spark lists the folders and prunes them at run time.
NAMED = 1000


def _pages_of(spark: SparkSession, root: str, schema, wanted: DataFrame, named: int) -> DataFrame:
    """Pages under ``<root>/playlist_id=<id>/`` of the playlists in ``wanted`` (column ``playlist_id``).

    Only their folders are read: few are named to the scan; many are met by a join on the partition
    column, from whose broadcast side Spark prunes the folders (dynamic partition pruning)."""
    full = T.StructType([*schema.fields, T.StructField(PLAYLIST, T.StringType())])
    asked = wanted.select(PLAYLIST).where(F.length(PLAYLIST) > 0).distinct()
    few = [r[0] for r in asked.limit(named + 1).collect()]
    if len(few) <= named:
        landed = {n[len(PLAYLIST) + 1:] for n in fs.list_names(spark, root)}
        paths = [f"{root}/{PLAYLIST}={x}" for x in sorted(few) if x in landed]
        if not paths:
            return spark.createDataFrame([], T.StructType([*full.fields, T.StructField("page_no", T.LongType())]))
    else:
        paths = [root]
    pages = (spark.read.schema(full).option("multiLine", True).option("mode", "FAILFAST")
                  .option("pathGlobFilter", "*.json").option("basePath", root).json(paths))
    pages = _with_page_no(pages)
    return pages if len(few) <= named else pages.join(asked, PLAYLIST, "left_semi")


def read_playlists(spark: SparkSession, root: str, wanted: DataFrame, named: int = NAMED) -> DataFrame:
    """``(playlist_id, page_no, items, nextPageToken)`` of the wanted playlists
    (``<root>/playlist_id=<id>/page_<n>.json``), read as one parallel scan."""
    return _pages_of(spark, root, schemas.PLAYLIST_PAGE, wanted, named).select(PLAYLIST, "page_no", "items", "nextPageToken")


def read_videos(spark: SparkSession, root: str, wanted: DataFrame, named: int = NAMED) -> DataFrame:
    """``(playlist_id, page_no, items)`` of the wanted playlists' videos responses."""
    return _pages_of(spark, root, schemas.VIDEOS_PAGE, wanted, named).select(PLAYLIST, "page_no", "items")
