"""Metric store of the streams (S14): rows per batch and file, and the progress of each batch, as an audit table.

One table, partitioned by (query, source, batch_id); a replayed batch replaces its own partitions, so a metric is never
counted twice.  ``source`` is

  file      one row per file content of the batch: rows seen and rows written;
  batch     one row: the totals, observed by the job that wrote the file rows (``Observation``);
  progress  one row: what the engine reports of the batch (``StreamingQueryListener``): rows read, milliseconds.

The three come from different places on purpose: a difference between them shows rows that went missing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources import tables as tb

PARTITION = ("query", "source", "batch_id")
TOTALS = ("files", "rows_seen", "rows_written", "duration_ms")


class MetricStore:
    """The metrics of one named stream under ``path``; several streams may share a path.

    The name is letters, digits and ``_.-`` (it names a folder and the streaming query).
    """

    def __init__(self, spark: SparkSession, path: str, query: str):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", query):
            raise ValueError(f"not a stream name: {query!r}")
        self.spark, self.path, self.query = spark, path, query

    def write_files(self, batch_id: int, files: DataFrame) -> dict:
        """Write the file rows of a batch (file_hash, rows_seen, rows_written) and their observed totals; return these.

        The totals are taken above the last shuffle, in the tasks that write, so a task that runs again counts once.
        A batch without files has totals of zero.  Null counts are taken as zero.
        """
        obs = Observation(f"{self.query}_{batch_id}")
        zero = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("rows_seen", "rows_written")]
        rows = files.select("file_hash", *zero)
        rows = rows.observe(obs, F.count(F.lit(1)).alias("files"), F.sum("rows_seen").alias("rows_seen"),
                            F.sum("rows_written").alias("rows_written"))
        # a replay may hold no file where the first attempt held some: what it wrote goes first
        tb.remove_folder(self.spark, f"{self.path}/query={self.query}/source=file/batch_id={batch_id}")
        self._write(rows.withColumn("files", F.lit(1).cast("long")), "file", batch_id)
        totals = {k: v or 0 for k, v in obs.get.items()}
        self.write_totals("batch", batch_id, totals)
        return totals

    def write_totals(self, source: str, batch_id: int, totals: dict) -> None:
        row = self.spark.createDataFrame([tuple(totals.get(c) for c in TOTALS)], ", ".join(f"{c} long" for c in TOTALS))
        self._write(row, source, batch_id)

    def _write(self, rows: DataFrame, source: str, batch_id: int) -> None:
        have = [F.col(c) if c in rows.columns else F.lit(None).cast("long").alias(c) for c in TOTALS]
        key = F.col("file_hash") if "file_hash" in rows.columns else F.lit(None).cast("string").alias("file_hash")
        tb.write_partitions(rows.select(key, *have, F.current_timestamp().alias("measured_at"), F.lit(self.query).alias("query"),
                                        F.lit(source).alias("source"), F.lit(batch_id).cast("long").alias("batch_id")), self.path, PARTITION)

    def read(self) -> DataFrame:
        """The stored metrics of this stream."""
        return tb.read_table(self.spark, self.path).filter(F.col("query") == self.query)


class ProgressListener(StreamingQueryListener):
    """Stores the engine's report of every batch of one named query.

    A report without input rows (an idle trigger, which carries the number of the next batch) is not stored.  An error in
    storing never reaches the stream; it is kept and rises in ``flush``.
    """

    def __init__(self, store: MetricStore):
        self.store, self.errors = store, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.store.query or not p.numInputRows:
            return
        try:
            self.store.write_totals("progress", p.batchId, {"rows_seen": p.numInputRows, "duration_ms": p.durationMs.get("triggerExecution")})
        except Exception as e:  # noqa: BLE001 - raised by flush
            self.errors.append(e)

    def flush(self, spark: SparkSession) -> None:
        """Wait until all reports so far are stored."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        if self.errors:
            raise self.errors[0]
