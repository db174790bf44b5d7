"""Streams give what the batch operators give, replays change nothing, unreadable messages are kept apart."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

import __spark_entry__ as entry
from vigilspark import constants as K
from vigilspark.operators import rules, store
from vigilspark.sources import external
from vigilspark.streaming import events as E
from vigilspark.streaming import jobs

EVENT = {
    "event_id": "TEST_001", "safetyreportid": "TEST123456", "is_serious": 1, "outcome_severity": 3, "drug_count": 2,
    "reaction_count": 2, "patient_risk_score": 1.5, "drug_risk_score": 1.2, "weight_group": 2, "age_group": 3,
    "occurcountry_encoded": 1, "primarysourcecountry_encoded": 1, "primary_drug_encoded": 5,
    "primary_reaction_encoded": 8, "report_month": 8, "report_year": 2025, "reporting_lag_days": 15,
    "timestamp": "2025-08-01T00:00:00", "source": "TEST_PRODUCER",
}


def messages(spark, values):
    return spark.createDataFrame([("k", v) for v in values], "key string, value string")


def test_parse(spark):
    values = [json.dumps(EVENT), '{"event_id": "n1", "drug_count": NaN}', "not json", '{"event_id": "cut', None, "[1]"]
    parsed = E.parse_messages(messages(spark, values))
    good = {r.event_id: r for r in E.readable_events(parsed).collect()}
    assert set(good) == {"TEST_001", "n1"}
    assert (good["TEST_001"].patient_risk_score, good["TEST_001"].drug_count) == ("1.5", "2")
    assert sorted(str(r.value) for r in E.dead_letters(parsed).collect()) == sorted(
        ["not json", '{"event_id": "cut', "None", "[1]"])


def test_model_alert(spark):
    events = E.readable_events(E.parse_messages(messages(spark, [json.dumps(EVENT)])))
    scored = events.withColumns({"confidence_serious": F.lit(0.95), "prediction": F.lit(1)})
    a = E.model_alerts(scored).first()
    assert (a.alert_id, a.event_id, a.safetyreportid) == ("ALERT_TEST_001", "TEST_001", "TEST123456")
    assert (a.alert_level, a.requires_review) == ("HIGH", 1)
    assert a.original_event.asDict() == {
        "outcome_severity": 3.0, "drug_count": 2, "reaction_count": 2, "patient_risk_score": 1.5, "source": "TEST_PRODUCER"}
    assert a.ml_prediction.asDict() == {
        "predicted_serious": 1, "confidence_serious": 0.95, "high_confidence": 1, "model_version": K.SCORE_MODEL_VERSION}
    assert a.alert_message == "SERIOUS ADVERSE EVENT DETECTED (Confidence: 95.0%) - High outcome severity"
    assert E.model_alerts(scored.withColumn("prediction", F.lit(0))).count() == 0


def rule_rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("event_id"),
        F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"),
        (F.col("id") % 3 == 0).cast("int").alias("seriousnesshospitalization"),
        (F.col("id") % 90).cast("double").alias("patient_age"),
    )


def test_rule_stream_equals_batch_and_replay_is_harmless(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    rule_rows(spark, 300).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema)
    jobs.store_rule_alerts(stream, root, str(tmp_path / "checkpoint"))
    batch = rules.assessed_with_source(rule_rows(spark, 300))

    def stored(name, *cols):
        return sorted(tuple(r) for r in store.read_table(spark, root, name).select(*cols).collect())

    want_events = sorted(tuple(r) for r in rules.rule_event_rows(batch).select("event_id", "serious", "outcome_severity").collect())
    want_alerts = sorted(tuple(r) for r in rules.rule_alerts(batch).select("event_id", "alert_message").collect())
    assert stored("adverse_events", "event_id", "serious", "outcome_severity") == want_events
    assert stored("safety_alerts", "event_id", "alert_message") == want_alerts

    # The same micro-batch once more, and its events again in a later micro-batch.
    write = jobs.rule_store_writer(root)
    write(rule_rows(spark, 300), 0)
    write(rule_rows(spark, 300).unionByName(rule_rows(spark, 10, 300)), 1)
    ids = [x[0] for x in stored("adverse_events", "event_id")]
    assert len(ids) == len(set(ids)) == 310
    alerts = [x[0] for x in stored("safety_alerts", "event_id")]
    assert len(alerts) == len(set(alerts))


def test_dedupe_and_minutes(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = rule_rows(spark, 500).withColumn("serious", (F.col("event_id").cast("int") % 4 == 0).cast("int"))
    rows.unionByName(rows).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema)
    assert jobs.drained(E.dedupe(stream, "ts", "1 hour").select("event_id"), "dedupe").count() == 500
    salted = E.dedupe(stream.withColumn("event_id", F.when(F.col("serious") == 1, "hot").otherwise(F.col("event_id"))), "ts", "1 hour", salts=4)
    assert jobs.drained(salted.select("event_id"), "dedupe-salted").count() == 376
    minutes = jobs.drain_updates(E.windowed_minutes(stream, "ts", "1 minute"), str(tmp_path / "m"), "minute")
    got = minutes.agg(F.sum("events"), F.sum("serious_events"), F.count("minute")).first()
    assert tuple(got) == (1000, 250, 9)


def test_bounded_run_and_stats(spark, tmp_path):
    source = str(tmp_path / "in")
    rule_rows(spark, 400).repartition(8).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema, maxFilesPerTrigger=1)
    scored = E.with_stats(stream.withColumn("prediction", F.col("seriousnesshospitalization")))
    query = scored.select("event_id").writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c1")).start(str(tmp_path / "o1"))
    seen = jobs.run_bounded(query, idle_seconds=30, max_events=150, poll_seconds=0.1)
    assert seen >= 150
    query = scored.select("event_id").writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c2")).start(str(tmp_path / "o2"))
    assert jobs.run_bounded(query, idle_seconds=5, poll_seconds=0.1) == 400
    with jobs.run_stats(spark) as run:
        jobs.drain_to_parquet(scored.select("event_id"), str(tmp_path / "o3"), str(tmp_path / "c3"))
    stats = run.totals()
    assert (stats["processed"], stats["serious_predicted"], stats["alerts_sent"]) == (400, 134, 134)
    assert stats["serious_percent"] == 33.5 and stats["events_per_minute"] > 0


class LateReports(StreamingQueryListener):
    """Holds up the reports of micro-batches, as a busy driver does."""

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        time.sleep(4)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def test_bounded_query_stops_though_reports_come_late(spark):
    late = LateReports()
    spark.streams.addListener(late)
    try:
        row = entry.queries()["stream_bounded_run"](spark, entry.SMOKE_DIR).first()
    finally:
        spark.streams.removeListener(late)
    assert row.asDict() == {"enough": True, "stopped_in_time": True, "strangers": 0}


def test_bounded_query_on_few_events_and_missing_ids(spark, tmp_path):
    events = spark.read.parquet(f"{entry.SMOKE_DIR}/events.parquet").limit(6)
    missing = events.withColumn("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id")))
    for name, rows in (("empty", events.where("false")), ("one", events.limit(1)), ("missing", missing)):
        rows.write.parquet(str(tmp_path / name / "events.parquet"))
        row = entry.queries()["stream_bounded_run"](spark, str(tmp_path / name)).first()
        assert row.asDict() == {"enough": True, "stopped_in_time": True, "strangers": 0}, name


def test_limited_run_refuses_what_comes_after_and_goes_on_from_there(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    rule_rows(spark, 400).repartition(8).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema, maxFilesPerTrigger=1)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    # The limit is first looked at when the stream has long refused its next micro-batch.
    largest = spark.read.parquet(source).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    first = jobs.run_limited(stream, write, checkpoint, 150, poll_seconds=8)
    assert 150 <= first < 150 + largest and spark.read.parquet(out).count() == first
    assert jobs.run_limited(stream, write, checkpoint, 1000, idle_seconds=3, poll_seconds=0.1) == 400 - first
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == sorted(str(n) for n in range(400))

    def fail(batch, batch_id):
        raise RuntimeError("died")

    with pytest.raises(StreamingQueryException, match="died"):
        jobs.run_limited(stream, fail, str(tmp_path / "c2"), 150, poll_seconds=0.1)


def test_a_long_micro_batch_is_not_idle(spark, tmp_path):
    source = str(tmp_path / "in")
    rule_rows(spark, 40).repartition(4).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema, maxFilesPerTrigger=2)

    def slow(batch, batch_id):
        batch.write.format("noop").mode("append").save()
        time.sleep(5)

    query = stream.writeStream.foreachBatch(slow).option("checkpointLocation", str(tmp_path / "c")).start()
    assert jobs.run_bounded(query, idle_seconds=2, poll_seconds=0.1) == 40


def test_durable_stats(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stats")
    rule_rows(spark, 300).withColumn("prediction", F.col("seriousnesshospitalization")).repartition(6).write.parquet(source)
    stream = E.read_event_files(spark, source, spark.read.parquet(source).schema, maxFilesPerTrigger=1)
    assert jobs.durable_stats(spark, folder)["processed"] == 0
    tries = []

    def write(batch, batch_id):
        tries.append(batch_id)
        batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"b{batch_id}"))
        if tries.count(batch_id) == 1 and batch_id in (0, 3):
            raise RuntimeError("died")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            jobs.drain_batches(stream, jobs.with_durable_stats(write, folder), str(tmp_path / "checkpoint"))
    jobs.drain_batches(stream, jobs.with_durable_stats(write, folder), str(tmp_path / "checkpoint"))
    totals = jobs.durable_stats(spark, folder)
    assert (totals["processed"], totals["serious_predicted"]) == (300, 100) and totals["events_per_minute"] > 0
    assert tries.count(0) == tries.count(3) == 2 and max(tries) == 5
    # A batch that was counted and comes again counts once.
    last = spark.read.parquet(str(tmp_path / "out" / "b5"))
    jobs.with_durable_stats(write, folder)(spark.createDataFrame(last.collect(), last.schema), 5)
    assert jobs.durable_stats(spark, folder)["processed"] == 300


def test_closed_minutes_drop_and_count_late_rows(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path)
    late = []
    for start, n in ((0, 600), (100, 50), (1200, 60)):  # ten minutes, some of them again under new ids, a later minute
        rows = rule_rows(spark, n, start).withColumn("serious", F.col("seriousnesshospitalization"))
        rows.withColumn("event_id", F.concat(F.lit(f"{start}-{n}-"), "event_id")).write.mode("append").parquet(source)
        stream = E.read_event_files(spark, source, rows.schema)
        minutes = E.closed_minutes(E.dedupe(stream, "ts", "2 minutes"), "ts")
        with jobs.run_stats(spark) as stats:
            query = jobs.drain_to_parquet(minutes, f"{base}/out", f"{base}/checkpoint")
        late.append(stats.late)
    got = spark.read.parquet(f"{base}/out").orderBy("minute").collect()
    assert late == [0, 50, 0] and [r.events for r in got] == [60] * 10
    assert len({r.minute for r in got}) == 10 and all(r.serious_events == 20 for r in got)
    steps = [s for p in query.recentProgress for s in json.loads(p.json)["stateOperators"]]
    assert steps and all(any(name.startswith("rocksdb") for name in s["customMetrics"]) for s in steps)


def test_envelope(spark):
    rows = spark.createDataFrame([(7, "2024-01-01 00:02:30", "r7"), (1234567, "2024-01-01 00:00:00", None)],
                                 "n int, t string, safetyreportid string").withColumn("t", F.col("t").cast("timestamp"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    got = [(r.event_id, r.source, r.stream_batch, r.key) for r in E.envelope(rows, F.col("n"), F.col("t"), start).collect()]
    assert got == [("AE_000007", "FDA_FAERS_STREAM", 3, "safety_report_r7"),
                   ("AE_1234567", "FDA_FAERS_STREAM", 1, "safety_report_1234567")]


def test_topic_messages_and_options(spark):
    row = external.as_messages(spark.createDataFrame([("a", 1)], "id string, n int"), F.col("id")).first()
    assert (row.key, json.loads(row.value)) == ("a", {"id": "a", "n": 1})
    assert external.kafka_read_options("h:1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "adverse-events", "startingOffsets": "latest"}
    assert external.kafka_read_options("h:1", max_per_trigger=100)["maxOffsetsPerTrigger"] == "100"
    assert external.kafka_write_options("h:1", K.TOPIC_EVENTS, acks="all", retries=3) == {
        "kafka.bootstrap.servers": "h:1", "topic": "adverse-events", "kafka.acks": "all", "kafka.retries": "3"}
    assert external.jdbc_write_options("jdbc:x", "adverse_events")["batchsize"] == "1000"
