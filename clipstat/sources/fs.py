"""Driver-side file listing through the cluster's Hadoop FileSystem (metadata only)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (files and folders)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists already (one of several creators wins)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        fs.create(p, False).close()
        return True
    except Exception as e:  # lost the race: somebody else created it in between
        if "exist" in str(e).lower():
            return False
        raise


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; False if it exists already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    part = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")[1]
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
