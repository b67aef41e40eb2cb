"""Offering landed files to the run, with state per file.

One row of state per content hash, in the state store of a streaming query: how
often the file failed and whether it is offered, waiting, done or given up.  The
events of the run (landed, failed, blocked, success) change it, and timers offer
failed and blocked files again after a while and forget finished ones:

    landed    first time: OFFER; later copies and replays change nothing
    failed    after ``retry``: OFFER again; the ``max_retries``-th time: GIVE_UP
    blocked   after ``reoffer``: OFFER again (a mapping may have been approved); not counted as a failure
    success   DEQUEUE, once
    done or given up for ``keep``: forgotten, so the content may land anew

Timers run on the time of the events (their watermark), so a replay after a
failure gives the same rows.  State is bounded by the files of the last ``keep``
days.  The actions go to a table, each batch to its own partition, so a batch
that is replayed replaces its rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ingest import MAX_RETRIES
from ..sources.tables import table_exists

LANDED, FAILED, BLOCKED, SUCCESS = "LANDED", "FAILED", "BLOCKED", "SUCCESS"
EVENTS = "file_hash string, client_id string, file_name string, event string, at timestamp"
ACTIONS = "file_hash string, client_id string, file_name string, action string, failures int, at timestamp"
_STATE = "client_id string, file_name string, status string, failures int"
_ORDER = {LANDED: 0, BLOCKED: 1, FAILED: 2, SUCCESS: 3}


def _millis(at: dt.datetime) -> int:
    return int(at.timestamp() * 1000)


def _action(file_hash: str, client: str, name: str, action: str, failures: int, at: dt.datetime) -> Row:
    return Row(file_hash=file_hash, client_id=client, file_name=name, action=action, failures=failures, at=at)


class FileOffers(StatefulProcessor):
    """What becomes of one file, event by event."""

    def __init__(self, max_retries: int, retry: dt.timedelta, reoffer: dt.timedelta, keep: dt.timedelta):
        self.max_retries = max_retries
        self.retry, self.reoffer, self.keep = (int(x.total_seconds() * 1000) for x in (retry, reoffer, keep))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.file = handle.getValueState("file", _STATE)

    def _save(self, state: tuple, timer: int | None, known: bool) -> None:
        for old in list(self.handle.listTimers()) if known else ():
            self.handle.deleteTimer(old)
        if timer is not None:
            self.handle.registerTimer(timer)
        self.file.update(state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        landed, told = None, set()
        for r in rows:  # of a file that lands any number of times only the first copy is held
            if r.event == LANDED:
                first = (r.at, r.client_id or "", r.file_name or "")
                landed = first if landed is None else min(landed, first)
            elif r.event in _ORDER and r.at is not None:
                told.add((r.at, _ORDER[r.event], r.event, r.client_id or "", r.file_name or ""))
        events = sorted(told | ({(landed[0], 0, LANDED, *landed[1:])} if landed and landed[0] is not None else set()))
        # every call of the state store is a message to the JVM: the state is read once and written once, not by each event
        before = self.file.get() if events and self.file.exists() else None
        state, timer = before, None
        for at, _, event, client, name in events:
            step = self._step(state, event, at, client, name)
            if step is not None:
                state, timer, action = step
                if action is not None:
                    yield _action(key[0], state[0], state[1], action, state[3], at)
        if state is not before:
            self._save(state, timer, before is not None)

    def _step(self, known: tuple | None, event: str, at: dt.datetime, client: str, name: str) -> tuple[tuple, int | None, str | None] | None:
        """State, timer and action after an event; None if it changes nothing."""
        now = _millis(at)
        if known is None:
            return ((client, name, "OFFERED", 0), None, "OFFER") if event == LANDED else None
        client, name, status, failures = known
        if status in ("DONE", "GIVEN_UP") or event == LANDED:
            return None
        if event == SUCCESS:
            return (client, name, "DONE", failures), now + self.keep, "DEQUEUE"
        if status != "OFFERED":
            return None
        if event == BLOCKED:
            return (client, name, "WAITING", failures), now + self.reoffer, None
        if failures + 1 >= self.max_retries:
            return (client, name, "GIVEN_UP", failures + 1), now + self.keep, "GIVE_UP"
        return (client, name, "WAITING", failures + 1), now + self.retry, None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.file.exists():
            return
        client, name, status, failures = self.file.get()
        if status == "WAITING":
            self.file.update((client, name, "OFFERED", failures))
            at = dt.datetime.fromtimestamp(expiredTimerInfo.getExpiryTimeInMs() / 1000)
            yield _action(key[0], client, name, "OFFER", failures, at)
        elif status in ("DONE", "GIVEN_UP"):
            self.file.clear()

    def close(self) -> None:
        pass


def file_actions(events: DataFrame, max_retries: int = MAX_RETRIES, retry: dt.timedelta = dt.timedelta(minutes=10),
                 reoffer: dt.timedelta = dt.timedelta(hours=1), keep: dt.timedelta = dt.timedelta(days=30), lateness: str = "0 seconds") -> DataFrame:
    """Stream of actions (``ACTIONS``) from a stream of events (``EVENTS``). Rows without a hash or a time say nothing."""
    known = events.where("file_hash IS NOT NULL AND at IS NOT NULL").withWatermark("at", lateness)
    return known.groupBy("file_hash").transformWithState(FileOffers(max_retries, retry, reoffer, keep), ACTIONS, "Update", "EventTime")


def run_offers(spark: SparkSession, events: DataFrame, actions_path: str, checkpoint_path: str, available_now: bool = True, **limits):
    """Start the stream that writes the actions; with ``available_now`` process all that is there and stop.

    State lives in the RocksDB state store (spilling to disk, changes checkpointed); the provider is set for this query
    only.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def each(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(actions_path))

    w = file_actions(events, **limits).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    try:
        q = w.start()
        if available_now:
            q.awaitTermination()  # raises if the query failed
    finally:
        spark.conf.set(key, before)
    return q


def offered(actions: DataFrame) -> DataFrame:
    """The queue, files whose last action is an offer."""
    last = actions.groupBy("file_hash").agg(F.max_by(F.struct("client_id", "file_name", "action", "failures", "at"),
                                                    F.struct("at", "batch_id", (F.col("action") != "OFFER").alias("ends"))).alias("x"))
    return last.select("file_hash", "x.*").where("action = 'OFFER'").drop("action")


def run_events(spark: SparkSession, warehouse: str) -> DataFrame:
    """Stream of events from the audit tables of the batch run: files seen, failed attempts, the mapping gate, staging results."""
    w = warehouse.rstrip("/")
    parts = []
    for name, columns, event, where in (
            ("file_tracking", "client_id string, file_name string, file_hash string, tracked_at timestamp", F.lit(LANDED), None),
            ("ingestion_log", "client_id string, file_name string, file_hash string, status string, logged_at timestamp", F.col("status"), "status = 'FAILED'"),
            ("gate_log", "client_id string, file_name string, file_hash string, status string, checked_at timestamp", F.col("status"), "status = 'BLOCKED'"),
            ("staging_log", "client_id string, file_name string, file_hash string, status string, processed_at timestamp", F.col("status"), "status IN ('SUCCESS', 'FAILED')")):
        if not table_exists(spark, f"{w}/audit/{name}"):
            continue
        rows = spark.readStream.schema(columns).parquet(f"{w}/audit/{name}")
        rows = rows if where is None else rows.where(where)
        parts.append(rows.select("file_hash", "client_id", "file_name", event.alias("event"), F.col(columns.rsplit(", ", 1)[1].split()[0]).alias("at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
