"""Snapshot envelopes: choose the newest by name, read it without inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipstat import schemas
from clipstat.sources import fs

SNAPSHOT_SUFFIX = ".json"


class SnapshotSourceError(RuntimeError):
    pass


def latest_snapshot_path(spark: SparkSession, data_dir: str) -> str:
    """Path of the lexicographically greatest ``*.json`` entry of ``data_dir``.

    The choice is by *name* (not modification time, not content), as in the reference,
    so a name such as ``zzz.json`` outranks every timestamped name.  A missing folder or
    a folder without ``.json`` entries is an error.
    """
    if not fs.exists(spark, data_dir):
        raise SnapshotSourceError(f"folder {data_dir} does not exist")
    names = [n for n in fs.list_names(spark, data_dir) if n.endswith(SNAPSHOT_SUFFIX)]
    if not names:
        raise SnapshotSourceError(f"no {SNAPSHOT_SUFFIX} file in {data_dir}")
    # A snapshot folder written by Spark is complete only once its job committed
    # (_SUCCESS); a folder whose write died midway is passed over.  Only names from the
    # top down are checked, so the cost does not grow with the number of snapshots.
    for name in sorted(names, reverse=True):
        path = data_dir.rstrip("/") + "/" + name
        if not fs.is_dir(spark, path) or fs.exists(spark, path + "/_SUCCESS"):
            return path
    raise SnapshotSourceError(f"no complete {SNAPSHOT_SUFFIX} snapshot in {data_dir}")


def read_envelopes(spark: SparkSession, path: str, raw: bool = True) -> DataFrame:
    """Read snapshot envelopes at ``path``.

    A single file is one pretty-printed JSON document (``multiLine``).  A folder written
    by :func:`clipstat.sinks.envelope.write_snapshot` holds JSON-lines part files, one
    envelope chunk per line, so large snapshots are read in parallel.  Malformed input
    fails (``FAILFAST``).  With ``raw`` the videos stay JSON text (``ENVELOPE_RAW``).
    """
    schema = schemas.ENVELOPE_RAW if raw else schemas.ENVELOPE
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if fs.is_dir(spark, path):
        return reader.option("multiLine", False).option("pathGlobFilter", "*.json").json(path)
    return reader.option("multiLine", True).json(path)
