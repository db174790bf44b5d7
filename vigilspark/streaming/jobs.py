"""Running streams: bounded runs, file sinks, the rule-scoring store job and run statistics."""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import rules, store
from ..operators.columns import named
from ..session import scratch_dir


_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_outside_heap(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB, in native memory and on the executors' disks, and
    checkpoint its changes to the checkpoint folder. A restarted stream keeps the provider it began with."""
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    """Process everything available now into Parquet and stop."""
    with state_outside_heap(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path)
        )
    query.awaitTermination()
    return query


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str = "append") -> StreamingQuery:
    """Process everything available now by a ``foreachBatch`` function and stop."""
    with state_outside_heap(stream.sparkSession):
        query = (
            stream.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


def drained(stream: DataFrame, purpose: str) -> DataFrame:
    """Run the stream over what is available and read its output back as a batch."""
    spark = stream.sparkSession
    base = scratch_dir(spark, purpose)
    drain_to_parquet(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def drain_updates(stream: DataFrame, base: str, key: str) -> DataFrame:
    """Run an updating aggregate over what is available and read back the last update of every key.

    Each micro-batch writes the keys it changed to a folder of its own, which a retry replaces.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/update={batch_id}")

    drain_batches(stream, write, f"{base}/checkpoint", "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("update", T.LongType())])
    updates = spark.read.schema(schema).parquet(f"{base}/out")
    latest = updates.groupBy(key).agg(F.max_by(F.struct(*[named(c) for c in stream.columns]), "update").alias("row"))
    return latest.select("row.*")


class RunStats(StreamingQueryListener):
    """Totals of one query over all its micro-batches, readable while it runs.

    A query keeps only its latest progress reports; this listener adds up every one as it comes, and holds the sums alone.
    """

    def __init__(self, metrics: str = "stream_stats"):
        self.metrics = metrics
        self.lock = threading.Lock()
        self.query_id: str | None = None
        self.ended = threading.Event()
        self._clear()

    def _clear(self) -> None:
        self.last, self.rows, self.processed, self.serious, self.millis, self.late = -1, 0, 0, 0, 0, 0

    def follow(self, query: StreamingQuery) -> RunStats:
        """Count this query only, with the reports it still has from before."""
        with self.lock:
            self.query_id = str(query.id)
            self._clear()
            for progress in query.recentProgress:
                self._add(json.loads(progress.json))
        return self

    def _add(self, progress) -> None:
        if progress["batchId"] <= self.last:  # reports come in order; one that was counted may come twice
            return
        found = (progress.get("observedMetrics") or {}).get(self.metrics)
        seen = (found["processed"], found["serious_predicted"]) if found is not None else (0, 0)
        rows = progress["numInputRows"]
        # The first stateful step sees the stream's rows; the later ones what it lets through. The reports list the last first.
        late = [step.get("numRowsDroppedByWatermark", 0) for step in progress.get("stateOperators") or []][-1:]
        self.late += sum(late)
        if rows or any(seen):
            self.last = progress["batchId"]
            self.rows, self.processed, self.serious = self.rows + rows, self.processed + seen[0], self.serious + seen[1]
            self.millis += progress["durationMs"].get("triggerExecution", 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            if self.query_id in (None, str(event.progress.id)):
                self._add(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.query_id in (None, str(event.id)):
            self.ended.set()

    def totals(self) -> dict[str, float]:
        return _stats(self.processed, self.serious, self.millis)


def _stats(processed: int, serious: int, millis: float) -> dict[str, float]:
    minutes = millis / 60000
    return {
        "processed": processed,
        "serious_predicted": serious,
        "alerts_sent": serious,
        "serious_percent": serious * 100.0 / processed if processed else 0.0,
        "events_per_minute": processed / minutes if minutes else 0.0,
    }


_TOTALS = "batch_id long, processed long, serious_predicted long, millis double"


def _kept_totals(spark: SparkSession, folder: str, below: int | None = None) -> tuple:
    """The latest totals, or the latest before a batch. Two are kept, in places that batches use in turn."""
    found = []
    for slot in (0, 1):
        try:
            found += [tuple(r) for r in spark.read.schema(_TOTALS).parquet(f"{folder}/slot={slot}").collect()]  # one row
        except AnalysisException:  # not written yet
            pass
    found = [r for r in found if below is None or r[0] < below]
    return max(found, default=(-1, 0, 0, 0.0))


def with_durable_stats(write: Callable[[DataFrame, int], None], folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that does what ``write`` does and keeps the stream's totals up to each batch.

    The batch is kept while it is counted and written, so it is computed once. Its totals are those of the batch before it and
    its own, so a batch that is tried again counts once, and a stream that is stopped and started on its checkpoint goes on
    from where it was. The driver holds one row.
    """

    def counted(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _, processed, serious, millis = _kept_totals(spark, folder, batch_id)
        started = time.monotonic()
        # Counted, not observed: a session that has observed batches can no longer score with a fitted forest, whose training
        # summary holds the session.
        held = batch.persist()
        try:
            seen = held.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == 1).alias("serious")).first()
            write(held, batch_id)
        finally:
            held.unpersist()
        row = (batch_id, processed + seen.n, serious + seen.serious, millis + 1000 * (time.monotonic() - started))
        spark.createDataFrame([row], _TOTALS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/slot={batch_id % 2}")

    return counted


def durable_stats(spark: SparkSession, folder: str) -> dict[str, float]:
    """The totals that ``with_durable_stats`` has kept, whether or not the stream runs."""
    return _stats(*_kept_totals(spark, folder)[1:])


@contextmanager
def run_stats(spark: SparkSession, metrics: str = "stream_stats", settle_seconds: float = 10.0) -> Iterator[RunStats]:
    """Count what the one query started inside the block does; the block's end waits for its last report."""
    listener = RunStats(metrics)
    spark.streams.addListener(listener)
    try:
        yield listener
        listener.ended.wait(settle_seconds)
    finally:
        spark.streams.removeListener(listener)


def run_bounded(
    query: StreamingQuery, idle_seconds: float = 30.0, max_events: int | None = None, poll_seconds: float = 0.5
) -> int:
    """Let a running query go on until it has been idle or has seen enough events, then stop it.

    Returns the number of events processed. The limit is looked at from outside when reports come, so micro-batches that begin
    before then still count; ``run_limited`` lets none begin.
    """
    with run_stats(SparkSession.active()) as seen:
        seen.follow(query)
        _stop_when_idle_or_enough(query, lambda: seen.rows, idle_seconds, max_events, poll_seconds)
    return seen.rows


def _stop_when_idle_or_enough(query: StreamingQuery, rows: Callable[[], int], idle_seconds: float, max_events: int | None,
                              poll_seconds: float) -> None:
    news, count = time.monotonic(), rows()
    while query.isActive:
        found, status = rows(), query.status
        # A query that starts or works on a micro-batch is not idle, however long that takes.
        busy = status["message"].startswith("Initializing") or (status["isTriggerActive"] and status["isDataAvailable"])
        if busy or found > count:
            news, count = time.monotonic(), found
        if (max_events is not None and found >= max_events) or time.monotonic() - news > idle_seconds:
            break
        time.sleep(poll_seconds)
    query.stop()


class LimitReached(Exception):
    """Ends a stream whose limit was reached and which had not been stopped yet."""


def run_limited(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, max_events: int,
                idle_seconds: float = 30.0, poll_seconds: float = 0.5, **trigger) -> int:
    """Hand micro-batches to a ``foreachBatch`` function until they held enough events or none came for a while, then stop.

    Returns the number of events written. The stream itself keeps the limit: the micro-batch that reaches it is the last one
    written, however late the stop comes. A next one is refused before anything of it is written and not committed, so a
    stream that is started again on the checkpoint goes on with it. Each micro-batch is kept while it is counted and written.
    """
    state = (-1, 0, 0)  # latest micro-batch written, events up to it, events before it

    def limited(batch: DataFrame, batch_id: int) -> None:
        nonlocal state
        written = state[1]
        if written >= max_events:
            raise LimitReached(f"{written} events were written, the limit is {max_events}")
        held = batch.persist()
        try:
            rows = held.count()
            write(held, batch_id)
        finally:
            held.unpersist()
        state = (batch_id, written + rows, written)

    def committed() -> int:
        last, written, before = state
        report = query.lastProgress  # of the query itself, made before the next micro-batch begins
        return written if report is not None and report.batchId >= last else before

    with state_outside_heap(stream.sparkSession):
        query = (
            stream.writeStream.foreachBatch(limited).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "0 seconds"})).start()
        )
    _stop_when_idle_or_enough(query, committed, idle_seconds, max_events, poll_seconds)
    error = query.exception()
    if error is not None and LimitReached.__name__ not in str(error):
        raise error
    return state[1]


def rule_store_writer(root: str, now: Column | None = None, writer: str = "rules",
                      before_commit: Callable[[], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that scores a micro-batch and appends its events and alerts together.

    Both appends are keyed: an event id the store already has is not stored again, and an event gets one
    alert. Of one micro-batch's rows with the same id the first to arrive counts. Of the store only the keys that share a
    bucket with the micro-batch's are read. Alerts without an event in the store are left out. Both tables are one batch of
    the store, so a run that dies on the way shows neither, and a replayed micro-batch that was committed changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store.create_tables(spark, root, store.DAILY)
        if store.is_committed(spark, root, store.DAILY, batch_id, writer):
            return
        # Rows of a micro-batch come in the order of their partitions, which the sources fill in order.
        assessed = rules.assessed_with_source(batch).withColumn("_arrival", F.monotonically_increasing_id()).persist()
        try:
            events = store.conform(rules.rule_event_rows(assessed, now, "_arrival"), "adverse_events", now, keep=("_arrival",))
            alerts = store.conform(rules.rule_alerts(assessed, now, "_arrival"), "safety_alerts", now, keep=("_arrival",))
            known = store.read_keys(spark, root, "adverse_events", events)
            warned = store.read_keys(spark, root, "safety_alerts", alerts)
            new_events = store.insert_ignore(events, known, order="_arrival").drop("_arrival")
            new_alerts = store.insert_ignore(alerts, warned, order="_arrival").drop("_arrival")
            new_alerts = store.alerts_with_event(new_alerts, known.unionByName(new_events.select("event_id")))
            store.write_batch({"adverse_events": new_events, "safety_alerts": new_alerts}, root, batch_id, writer, before_commit)
        finally:
            assessed.unpersist()

    return write


def store_rule_alerts(
    stream: DataFrame, root: str, checkpoint: str, now: Column | None = None, writer: str | None = None,
    before_commit: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Score a stream by rules and keep events and alerts in the store.

    The writer's name keeps its batches apart from those of other streams; unless given it is made from the checkpoint,
    since batch numbers start again with a new one.
    """
    store.create_tables(stream.sparkSession, root, store.DAILY)
    name = writer or "stream" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    return drain_batches(stream, rule_store_writer(root, now, name, before_commit), checkpoint)
