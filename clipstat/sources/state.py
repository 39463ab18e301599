"""Results kept for each immutable unit of a table, so that a run computes new units only.

A unit is a load of staging or history, or a bucket of core as one publish wrote it; its rows never
change, so neither does what is computed from it.  Results lie under ``_state/<name>/part=<id>``, one
folder a run, published by one rename.  A run lists the current units, computes those that have no
result yet (also those that an earlier run missed because it died) and reads all results back.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.operators import quality
from clipstat.sources import fs
from clipstat.sources.tables import BUCKET, LOAD, VERSION_PREFIX, TableStore

UNIT = "unit"


def unit_results(store: TableStore, name: str, units: list[str], schema: str,
                 compute: Callable[[list[str]], DataFrame]) -> DataFrame:
    """Results of the ``units`` (columns ``unit`` and those of ``schema``); ``compute`` is given the units
    without one.  Only names of units pass through the driver."""
    spark, base = store.spark, store.path(f"_state/{name}")
    full = f"{UNIT} string, {schema}"

    def kept() -> DataFrame:
        if not any(n.startswith("part=") for n in fs.list_names(spark, base)):
            return spark.createDataFrame([], full)
        return spark.read.schema(full).parquet(base)

    done = {r[UNIT] for r in kept().select(UNIT).distinct().collect()}
    missing = [u for u in units if u not in done]
    if missing:
        part = uuid.uuid4().hex[:12]
        compute(missing).write.parquet(f"{base}/_writing-{part}")
        if not fs.rename(spark, f"{base}/_writing-{part}", f"{base}/part={part}"):
            raise RuntimeError(f"could not publish {base}/part={part}")
    wanted = spark.createDataFrame([(u,) for u in units], f"{UNIT} string")
    # two runs at once may both have computed a unit; the results are equal
    return kept().join(wanted, UNIT, "left_semi").distinct()


def _load_units(store: TableStore, table: str, folders: dict[str, str], units) -> DataFrame:
    """Rows of some units of staging or history, with the column ``unit``."""
    rows = store.read_loads(table, [folders[u] for u in units])
    grown = [u for u in units if "#" in u]  # at most one: the load of SQL inserts
    name = F.col(LOAD)
    for u in grown:
        name = F.when(F.col(LOAD) == u.split("#")[0], F.lit(u)).otherwise(name)
    return rows.withColumn(UNIT, name).drop(LOAD)


# ---- newest extraction of each channel ---------------------------------------------------

def newest_per_channel(store: TableStore) -> DataFrame:
    """``channel_handle, newest``: each channel's newest staged extraction, from one row for each load and
    channel; loads that have none yet are read (two columns of them)."""
    folders = store.units("staging")

    def compute(units):
        return _load_units(store, "staging", folders, units).groupBy(UNIT, "channel_handle").agg(F.max("extraction_date").alias("newest"))

    known = unit_results(store, "newest", sorted(folders), "channel_handle string, newest timestamp_ntz", compute)
    return known.groupBy("channel_handle").agg(F.max("newest").alias("newest"))


# ---- quality metrics -----------------------------------------------------------------------

def _core_units(store: TableStore, manifest: dict, buckets=None) -> DataFrame:
    """Rows of core with the column ``unit`` (``bucket@folder``)."""
    at = {b: v for b, v in manifest["at"].items() if buckets is None or f"{b}@{v}" in buckets}
    if not at:
        return store.spark.createDataFrame([], schemas.CORE).withColumn(UNIT, F.lit(""))
    full = schemas.CORE.simpleString()[len("struct<"):-1].replace(":", " ") + f", {VERSION_PREFIX[:-1]} int, {BUCKET} int"
    paths = [store.bucket_folder(b, v) for b, v in sorted(at.items())]
    rows = store.spark.read.schema(full).option("basePath", store.path("core")).parquet(*paths)
    return rows.withColumn(UNIT, F.concat_ws("@", BUCKET, VERSION_PREFIX[:-1]))


def incremental_metrics(store: TableStore, table: str, metrics) -> DataFrame:
    """:func:`clipstat.operators.quality.compute_metrics` of a table of the store, from the kept results of
    its units: new loads, and buckets of core that were written anew, are read, nothing else.

    ``duplicate_count`` merges for the key of core only, whose equal values share a bucket; other duplicate
    counts are computed over the whole table.  Results belong to a list of metrics: another list starts
    its own."""
    metrics = list(dict.fromkeys((m, c) for m, c in metrics))
    whole = [(m, c) for m, c in metrics if m == "duplicate_count" and (table, c) != ("core", "video_id")]
    merged = [mc for mc in metrics if mc not in whole]
    parts = []
    if merged:
        if table == "core":
            manifest = store.manifest()
            units = [f"{b}@{v}" for b, v in sorted(manifest["at"].items())]
            read = lambda some: _core_units(store, manifest, set(some))
        else:
            folders = store.units(table)
            units = sorted(folders)
            read = lambda some: _load_units(store, table, folders, some)
        name = hashlib.sha256(repr(sorted(merged, key=repr)).encode()).hexdigest()[:12]
        known = unit_results(store, f"checks/{table}/{name}", units, quality.UNIT_METRICS,
                             lambda some: quality.unit_metrics(read(some), UNIT, merged))
        parts.append(quality.merge_metrics(known, table, merged))
    if whole:
        parts.append(quality.compute_metrics(store.read(table), table, whole))
    return reduce(DataFrame.unionByName, parts)
