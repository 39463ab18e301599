"""Table writes: constraint checks, atomic appends with serial ids, core by touched buckets."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.operators import merge
from clipstat.operators.history import serial_ids
from clipstat.sources.tables import PARTITION, SCHEMAS, TableStore

# Parquet writer settings of staging and history: filters for point lookups of a video, as large as a
# row group's distinct ids ask for.
LOOKUP_OPTIONS = {"parquet.bloom.filter.enabled#video_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def enforce_constraints(df: DataFrame, table: str) -> DataFrame:
    """Fail the write job on a NULL in a NOT NULL column or an over-long VARCHAR.

    The checks are column expressions evaluated inside the write tasks - no extra pass.
    """
    checks = {}
    for c in schemas.NOT_NULL.get(table, []):
        checks.setdefault(c, []).append((F.col(c).isNull(), f"{table}.{c} is NULL"))
    for c, n in schemas.VARCHAR_LIMITS.get(table, {}).items():
        checks.setdefault(c, []).append((F.length(c) > n, f"{table}.{c} longer than {n}"))
    cols = []
    for f in SCHEMAS[table].fields:
        expr = F.col(f.name)
        for bad, msg in checks.get(f.name, []):
            expr = F.when(bad, F.raise_error(F.lit(msg)).cast(f.dataType)).otherwise(expr)
        cols.append(expr.cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in SCHEMAS[table].fields}]
    return df.select(*cols, *extra)


def append(store: TableStore, table: str, rows: DataFrame, id_col: str | None = None, token: str | None = None) -> int:
    """Append ``rows`` to an append-only table (staging, history) in one atomic step; returns the number of
    rows (counted by the write itself).

    The rows are written to a hidden folder, partitioned by day and sorted by video, and published by
    one rename.  ``token`` names the append: if it was published already nothing is written, whenever the
    run before died, and the rows it holds are counted.  Ids are reserved before the data is written: a
    failed write leaves a gap, never a duplicate.
    """
    token = token or uuid.uuid4().hex[:12]
    done = store.find_load(table, token)
    if done:
        return store.read_loads(table, [done.folder]).count()
    if id_col:
        rows = serial_ids(rows, store.reserve_ids(table, id_col), id_col)
    part_col, ts_col = PARTITION[table]
    written = Observation()
    out = enforce_constraints(rows, table).withColumn(part_col, F.to_date(ts_col)) \
        .observe(written, F.count(F.lit(1)).alias("rows"))
    keyed = "video_id" in out.columns
    (out.sortWithinPartitions(part_col, *["video_id"][:keyed]).write.options(**(LOOKUP_OPTIONS if keyed else {})).partitionBy(part_col)
        .parquet(store.writing_path(table, token)))
    store.publish_load(table, token)
    return int(written.get["rows"])


def assert_unique(df: DataFrame, key: str, what: str) -> None:
    """Fail if ``key`` repeats in ``df`` (a grouped count with partial aggregation; names a few)."""
    again = df.groupBy(key).count().where("count > 1").limit(3).collect()
    if again:
        raise ValueError(f"{what}: {key} is not unique: {[r[0] for r in again]}")


def touched_buckets(store: TableStore, source: DataFrame, manifest: dict) -> list[int]:
    """The buckets that the source's keys fall into (bounded by their number)."""
    return sorted(r[0] for r in source.select(store.bucket_of(manifest).alias("b")).distinct().collect())


def upsert_core(store: TableStore, source: DataFrame, as_of: dt.datetime, refresh=()) -> int:
    """Upsert ``source`` (unique keys) into core; returns the new version.

    Only the buckets that the source's keys fall into are read, merged and written; all others stay
    where they are.  The buckets are read as a table clustered by the key, so the outer join moves the
    source only, and a bucket is merged and written by one task as one file.
    """
    manifest = store.manifest()
    touched = touched_buckets(store, source, manifest)
    with store.bucketed_core(manifest, touched) as target:
        merged = merge.upsert(target, source, as_of, refresh=refresh, strategy="shuffle")
        folder = store.write_buckets(enforce_constraints(merged, "core"), manifest)
    return store.commit_core(folder, manifest, set(touched))


def publish(store: TableStore, rows: DataFrame) -> int:
    """Replace core by ``rows``: every bucket is written anew, one file each; returns the version."""
    manifest = store.manifest()
    dealt = enforce_constraints(rows, "core").repartition(manifest["buckets"], "video_id")
    return store.commit_core(store.write_buckets(dealt, manifest), manifest, set(range(manifest["buckets"])))
