"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.session import ensure_checkpoint_dir

# Fixed by the data contracts: a word is a run of anything but these ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows handed on at once by the Python stages; bounds what a worker holds beside its input batch.
ROWS_OUT = 2000
# Rows of a text table that Spark hands to a Python worker at once (its default is 10,000, whatever
# their length); batches stand in the JVM's and the worker's memory at the same time.
BATCH_ROWS = 1024
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session to ``BATCH_ROWS`` rows (a smaller setting stays)."""
    now = int(spark.conf.get(_BATCH_KEY, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the cluster's shared checkpoint folder and read it back.

    The result no longer depends on executor-local shuffle files, is computed once however many
    branches read it, and keeps row ids made by ``monotonically_increasing_id`` fixed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROW_KEY = ["_llm_file", "_llm_at"]


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with two columns that tell its rows apart: a hash of the Parquet file's path and the row's place
    in the file.  However often and by whatever executors the rows are read, the key stays (unlike a
    number given by the partition).  Rows that do not come straight from Parquet files, or may have been
    multiplied on the way (by a join or an explode), are staged first."""
    def key(rows: DataFrame) -> DataFrame:
        meta = rows.select(*[quoted(c) for c in df.columns], F.xxhash64("_metadata.file_path").alias(ROW_KEY[0]),
                           F.col("_metadata.row_index").alias(ROW_KEY[1]))
        meta.schema  # analysed here
        return meta

    plan = df._jdf.queryExecution().analyzed().toString()
    if all(line.strip(" :+-").split(" ")[0] in ("Project", "Filter", "Relation", "SubqueryAlias") for line in plan.strip().splitlines()):
        try:
            return key(df)
        except AnalysisException:
            pass
    return key(stage(df, name))


def ordered_stage(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` sorted over the whole cluster, staged with ``_part`` (range) and ``_pos`` (place in it).

    ``keys`` should end in a column that tells rows apart and does not change when a task is run again
    (a row number taken at the scan or from a staged table), so that a range boundary can fall
    inside any group, however large.  The columns of ``df`` move once.
    """
    mono = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_part", F.shiftright(mono, 33).cast("int")).withColumn("_pos", mono.bitwiseAND(F.lit((1 << 33) - 1)))
    return stage(placed, name)


def with_rank(ordered: DataFrame) -> DataFrame:
    """Add ``_rank`` (0-based, gapless) to the result of :func:`ordered_stage`.

    Only one count per range goes through the driver (bounded by the number of partitions).
    """
    spark = ordered.sparkSession
    starts, total = [], 0
    for part, n in sorted(ordered.groupBy("_part").count().collect()):
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    return ordered.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_start") + F.col("_pos")).drop("_start")


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str,
             as_bytes: tuple[str, ...] = ()) -> DataFrame:
    """Run ``rows`` (an iterator of tuples to an iterator of tuples) once per partition over Arrow
    batches.  Input is read batch by batch and output is flushed every ``ROWS_OUT`` rows, so a
    worker never holds a partition.  Columns in ``as_bytes`` arrive as UTF-8 bytes."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    small_batches(df.sparkSession)
    target = _parse_datatype_string(schema)
    out_schema = to_arrow_schema(target)
    names = df.columns

    def run(batches):
        def tuples():
            for batch in batches:
                cols = []
                for i, c in enumerate(names):
                    col = batch.column(i)
                    if c in as_bytes:
                        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
                    cols.append(col)
                for lo in range(0, batch.num_rows, 256):  # Python objects for a slice at a time
                    yield from zip(*(c.slice(lo, 256).to_pylist() for c in cols))

        def flush(buf):
            cols = list(zip(*buf))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, out_schema)], schema=out_schema)

        buf: list[tuple] = []
        for row in rows(tuples()):
            buf.append(row)
            if len(buf) >= ROWS_OUT:
                yield flush(buf)
                buf = []
        if buf:
            yield flush(buf)

    return df.mapInArrow(run, target)
