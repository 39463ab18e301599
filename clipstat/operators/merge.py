"""Keyed insert-or-update of the core table (the reference's ON CONFLICT DO UPDATE).

Parquet tables support neither MERGE nor overwriting a table that is being read, so the
upsert is a pure function ``(target, source) -> new target`` and the sink publishes the
result as a new table version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.functions.columns import ntz

KEY = "video_id"
# Columns the reference's DO UPDATE SET overwrites; every other non-key
# column keeps its first-insert value ("sticky"), and updated_at is set to the run time.
UPDATED = ["title", "duration_seconds", "duration_formatted", "like_count", "view_count",
           "comment_count", "content_type", "engagement_ratio", "is_short"]
STICKY = ["published_at", "channel_handle", "extraction_date"]
OUTPUT = [f.name for f in schemas.CORE.fields]


def _plan(refresh) -> tuple[list[str], list[str]]:
    refresh = tuple(refresh or ())
    unknown = set(refresh) - set(STICKY)
    if unknown:
        raise ValueError(f"refresh columns must be among {STICKY}: {sorted(unknown)}")
    return UPDATED + [c for c in STICKY if c in refresh], [c for c in STICKY if c not in refresh]


def upsert(target: DataFrame, source: DataFrame, as_of: dt.datetime, refresh=(),
           strategy: str = "auto") -> DataFrame:
    """New core table after upserting ``source`` (13 core columns, unique keys).

    ``refresh`` names sticky columns that should be overwritten too (e.g.
    ``("extraction_date",)`` for a real daily history).  ``strategy``:

    * ``"split"`` - ``target LEFT JOIN source`` gives kept and updated rows,
      ``source LEFT ANTI target keys`` gives inserts.  No hint: AQE broadcasts the source
      when its size at run time allows (the target is then not shuffled) and shuffles
      otherwise.  A target stored bucketed by the key keeps its partitioning either way, so
      it can be written back one file per bucket.
    * ``"shuffle"`` - one full-outer join on the key (both sides shuffled once).
    * ``"auto"`` - split.
    """
    overwrite, keep = _plan(refresh)
    now = ntz(as_of)
    source = source.select(*schemas.CORE_COLUMNS)
    target = target.select(*OUTPUT)
    if strategy in ("auto", "split"):
        return _upsert_split(target, source, now, overwrite, keep)
    if strategy == "shuffle":
        return _upsert_full_outer(target, source, now, overwrite, keep)
    raise ValueError(f"unknown strategy {strategy!r}")


def _upsert_full_outer(target, source, now, overwrite, keep) -> DataFrame:
    t, s = target.alias("t"), source.alias("s")
    hit = F.col("s." + KEY).isNotNull()
    found = F.col("t." + KEY).isNotNull()
    cols = {KEY: F.coalesce(F.col("s." + KEY), F.col("t." + KEY))}
    for c in overwrite:
        cols[c] = F.when(hit, F.col("s." + c)).otherwise(F.col("t." + c))
    for c in keep:
        cols[c] = F.when(found, F.col("t." + c)).otherwise(F.col("s." + c))
    cols["updated_at"] = F.when(hit, now).otherwise(F.col("t.updated_at"))
    joined = t.join(s, F.col("t." + KEY) == F.col("s." + KEY), "full_outer")
    return joined.select(*[cols[c].alias(c) for c in OUTPUT])


def _upsert_split(target, source, now, overwrite, keep) -> DataFrame:
    incoming = source.select(*[F.col(c).alias("_s_" + c) for c in source.columns])
    hit = F.col("_s_" + KEY).isNotNull()
    cols = {KEY: F.col(KEY)}
    for c in overwrite:
        cols[c] = F.when(hit, F.col("_s_" + c)).otherwise(F.col(c))
    for c in keep:
        cols[c] = F.col(c)
    cols["updated_at"] = F.when(hit, now).otherwise(F.col("updated_at"))
    kept_or_updated = (target.join(incoming, F.col(KEY) == F.col("_s_" + KEY), "left")
                             .select(*[cols[c].alias(c) for c in OUTPUT]))
    inserted = source.join(target.select(KEY), KEY, "left_anti")
    return kept_or_updated.unionByName(inserted.withColumn("updated_at", now).select(*OUTPUT))
