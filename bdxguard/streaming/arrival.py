"""Arrival of bordereau files as a Structured Streaming job.

The reference polls a folder every 60 s.  Here a file-source stream feeds
``foreachBatch``: each micro-batch registers the new files once per content
hash (first arrival wins), skipping hashes already tracked, and writes its rows
to the tracking table partition of its batch id.  Replaying a batch after a
failure overwrites that same partition, so the sink is idempotent and the
checkpoint gives exactly-once registration.  Content identity is unbounded in
time, so there is no watermark: the tracking table is the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import register_files
from ..sources import tables as tb
from .metrics import MetricStore, ProgressListener

PAYLOAD = ("file_hash", "doc_id", "client_id", "file_name", "rel_path")


def _existing(spark: SparkSession, tracking_path: str, batch_id: int) -> DataFrame | None:
    t = tb.try_read(spark, tracking_path)
    return None if t is None else t.filter(F.col("batch_id") != batch_id)


def register_batch(spark: SparkSession, files: DataFrame, batch_id: int, tracking_path: str,
                   order: tuple[str, ...] = ("doc_id",), payload: tuple[str, ...] = PAYLOAD,
                   store: MetricStore | None = None) -> dict:
    """S16 for one micro-batch; returns the observed number of registered rows.

    With a ``store``, the sightings of each content and whether it was registered are stored too.  The narrow inventory
    of the batch is written first, so the batch itself is read once however many steps need it.
    """
    files = tb.materialize(files.select(*dict.fromkeys(["file_hash", *order, *payload])), "arrived")
    new = register_files(files, _existing(spark, tracking_path, batch_id), order=list(order), payload=list(payload))
    obs = Observation(f"registered_{batch_id}")
    new = new.withColumn("batch_id", F.lit(batch_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
    (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(tracking_path))
    if store is not None:
        seen = files.groupBy("file_hash").agg(F.count(F.lit(1)).alias("rows_seen"))
        mine = tb.read_table(spark, tracking_path).filter(F.col("batch_id") == batch_id).select("file_hash", F.lit(1).alias("rows_written"))
        store.write_files(batch_id, seen.join(mine, "file_hash", "left"))
    return obs.get


def _start(spark: SparkSession, stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint_path: str,
           available_now: bool, store: MetricStore | None):
    """Start the stream, with its progress stored; with ``available_now`` wait until all that is there is done."""
    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    if store is None:
        q = w.start()
        if available_now:
            q.awaitTermination()  # raises if the query failed
        return q
    listener = ProgressListener(store)
    spark.streams.addListener(listener)
    try:
        q = w.queryName(store.query).start()
        if available_now:
            q.awaitTermination()
            listener.flush(spark)
    finally:
        if available_now:       # a continuous query keeps its listener as long as the session
            spark.streams.removeListener(listener)
    return q


def run_arrivals(spark: SparkSession, stream: DataFrame, tracking_path: str, checkpoint_path: str,
                 to_files: Callable[[DataFrame], DataFrame], order=("doc_id",), payload=PAYLOAD,
                 available_now: bool = True, store: MetricStore | None = None):
    """Start the arrival stream; with ``available_now`` process all that is there, however long it takes, and stop.

    A failed batch raises; the returned metrics hold the rows each batch registered.  With a ``store`` the metrics of
    every batch and file are kept in its table.
    """
    metrics: list[dict] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        metrics.append(register_batch(spark, to_files(batch), batch_id, tracking_path, order, payload, store))

    return _start(spark, stream, each, checkpoint_path, available_now, store), metrics


def landing_stream(spark: SparkSession, landing: str, warehouse: str, meta, checkpoint_path: str,
                   available_now: bool = True):
    """K1 end to end: CSV files landing under ``landing`` (any client folder) are picked up by a
    ``binaryFile`` stream; every micro-batch runs the batch pipeline on its new files.

    The stream checkpoint remembers which files were offered; what became of them
    is in the run's own logs, and the rows of each file and batch in ``audit/stream_metrics``.  A batch that is replayed after a failure has the
    same run id: files it already finished are skipped, files it had only
    registered are processed.  Each batch also takes up files of earlier batches
    that were blocked or failed.  The poll interval (60 s) is the processing-time
    trigger when ``available_now`` is false.
    """
    from ..plans.pipeline import run_files
    from ..sources.files import inventory_from_binary

    schema = "path string, modificationTime timestamp, length bigint, content binary"
    stream = (spark.readStream.format("binaryFile").schema(schema)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(landing))
    runs: list[str] = []
    store = MetricStore(spark, f"{warehouse.rstrip('/')}/audit/stream_metrics", "landing")

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream_{batch_id:08d}"
        run_files(spark, inventory_from_binary(batch, landing), warehouse, meta, run_id)
        log = tb.try_read(spark, f"{warehouse.rstrip('/')}/audit/ingestion_log")
        if log is not None:
            store.write_files(batch_id, file_rows(log, run_id))
        runs.append(run_id)

    return _start(spark, stream, each, checkpoint_path, available_now, store), runs


def file_rows(ingestion_log: DataFrame, run_id: str) -> DataFrame:
    """Rows read and written per file content by the latest attempt of a run; copies of a file are no attempt."""
    mine = ingestion_log.filter((F.col("run_id") == run_id) & ~F.col("status").isin("DUPLICATE", "CROSS_CLIENT_DUP"))
    last = mine.groupBy("file_hash").agg(F.max_by(F.struct("rows_read", "rows_written"), "logged_at").alias("x"))
    return last.select("file_hash", F.col("x.rows_read").alias("rows_seen"), F.col("x.rows_written").alias("rows_written"))
