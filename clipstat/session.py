"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every clipstat job relies on.  Time zone is fixed so that aware API
# timestamps land as UTC wall-clock in TIMESTAMP_NTZ columns; ANSI mode makes malformed
# casts fail the job, as the reference's database does.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# A shuffle partition is planned for about so many bytes.
PARTITION_BYTES = 128 << 20


def planned_partitions(shuffle_bytes: int) -> int:
    """Shuffle partitions for a largest shuffle of ``shuffle_bytes`` (at least Spark's 200; AQE
    coalesces what turns out smaller)."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(master: str | None = None, app_name: str = "clipstat", shuffle_partitions: int | None = None,
                  extra: dict | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with clipstat's required settings.

    Spark's default of 200 shuffle partitions is far too few for large windows and joins: pass
    the number, or the size of the largest shuffle expected (``shuffle_bytes``).

    On a cluster ``master`` stays ``None`` so spark-submit decides.  The web UI is kept
    off: jobs are inspected through ``explain()`` and the event log.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is None and shuffle_bytes:
        shuffle_partitions = planned_partitions(shuffle_bytes)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/object store); it
    is read, never overridden.  Only local runs without it (tests) get a fresh scratch
    directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="clipstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
