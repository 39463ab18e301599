"""File-source stream of snapshot envelopes -> staging -> core -> history.

A Spark-side addition (the reference runs as a daily batch): new snapshots in a folder
(single ``*.json`` documents, and the snapshot folders that
:func:`clipstat.sinks.envelope.publish_envelopes` writes) are picked up with
``trigger(availableNow=True)``, and each micro-batch runs the steps of
:func:`clipstat.plans.pipelines.run_update` for each of its extractions in turn.

Progress is kept beside the store it fills, so a restarted application resumes where the
last one stopped.  A micro-batch's rows become visible in staging by one rename to a folder named by the
stream and the batch, so a replay after a crash at any point neither loses nor repeats them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clipstat import schemas
from clipstat.functions.columns import ntz, parse_extraction_date
from clipstat.plans import pipelines
from clipstat.sinks import tables as table_sink
from clipstat.sources.tables import TableStore, drop_work, work_table


def _newest_other(store: TableStore, dates: list[dt.datetime]) -> dt.datetime | None:
    """The newest staged extraction besides ``dates``; looks at one day's folder after another,
    newest first."""
    for day in reversed(store.days("staging")):
        rows = store.read_day("staging", day)
        found = rows.where(~F.col("extraction_date").isin([ntz(d) for d in dates])).agg(F.max("extraction_date")).first()[0]
        if found is not None:
            return found
    return None


def process_envelopes(envelopes: DataFrame, store: TableStore, as_of: dt.datetime, refresh=(),
                      epoch: tuple[str, int] | None = None) -> list[tuple]:
    """One micro-batch: append staging, then upsert core and append history for each of its
    extractions, oldest first (their number is bounded by the files of a batch).  ``epoch`` is
    the stream's id and the batch's number: staging publishes its rows under that name in one step, so
    a replay finds them whole or not at all.  An extraction that arrives after a newer one adds the
    videos core does not have and updates none.  Returns the audit rows of each extraction."""
    at = envelopes.select(parse_extraction_date("extraction_date").alias("at"), F.size("videos").alias("n"))
    rows = {r["at"]: r["n"] for r in at.groupBy("at").agg(F.sum("n").alias("n")).collect()}
    extractions = sorted(rows)
    pipelines.load_staging(store, envelopes, as_of, token=f"{epoch[0]}-{epoch[1]}" if epoch else None)
    ahead = _newest_other(store, extractions)
    audit = []
    for newest in extractions:
        version = pipelines.transform(store, as_of, refresh, newest=newest, only_new=ahead is not None and newest < ahead)
        audit += pipelines.update_audit(store, rows[newest], newest.isoformat(), version, as_of)
    return audit


def read_stream(spark: SparkSession, data_dir: str, files_per_batch: int = 1) -> DataFrame:
    """Raw envelopes (``schemas.ENVELOPE_RAW``) of new files.  A file directly in ``data_dir``
    is one JSON document; the part files of a ``*.json`` folder hold one envelope a line and are read
    by lines, so a large part is split over tasks; a folder still being written (``*.tmp``) is passed over."""
    text = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
    documents = text.option("wholetext", True).option("pathGlobFilter", "*.json").load(data_dir)
    lines = text.option("wholetext", False).load(f"{data_dir.rstrip('/')}/*.json/part-*")
    parsed = F.from_json("value", schemas.ENVELOPE_RAW, {"mode": "FAILFAST"})
    return documents.select("value").unionByName(lines.select("value")).where(F.length("value") > 0).select(parsed.alias("e")).select("e.*")


OBSERVED = "clipstat_ingest"


class IngestListener(StreamingQueryListener):
    """Counts of every micro-batch as the stream itself observed them: ``batches[batch_id]`` is
    ``(envelopes, videos)``.  Compare with the audit's ``staged`` rows."""

    def __init__(self) -> None:
        self.batches: dict[int, tuple[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if seen is not None and seen["envelopes"]:
            self.batches[event.progress.batchId] = (seen["envelopes"], seen["videos"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_ingest(spark: SparkSession, data_dir: str, store: TableStore, checkpoint_location: str | None = None,
                 clock=dt.datetime.now, refresh=(), files_per_batch: int = 1) -> StreamingQuery:
    """Start the ingest; returns the query (``awaitTermination()`` to wait for it).

    Every micro-batch appends its audit rows (a row for each extraction and step, as
    :func:`clipstat.plans.pipelines.run_update` returns them) to the store's table ``audit``, once."""
    location = checkpoint_location or store.path("_stream")

    def batch(df: DataFrame, epoch_id: int) -> None:
        made: list[str] = []
        try:
            envelopes = work_table(df, "envelopes", made)  # the files are parsed, and observed, once
            if not envelopes.isEmpty():
                # the id belongs to the checkpoint: a new checkpoint starts a new count
                stream = str(df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
                audit = process_envelopes(envelopes, store, clock(), refresh, (stream, epoch_id))
                table_sink.append(store, "audit", spark.createDataFrame(audit, schemas.AUDIT), token=f"{stream}-{epoch_id}")
        finally:
            drop_work(spark, made)

    envelopes = read_stream(spark, data_dir, files_per_batch).observe(
        OBSERVED, F.count(F.lit(1)).alias("envelopes"), F.coalesce(F.sum(F.size("videos")), F.lit(0)).alias("videos"))
    return (envelopes.writeStream.foreachBatch(batch)
            .option("checkpointLocation", location).trigger(availableNow=True).start())
