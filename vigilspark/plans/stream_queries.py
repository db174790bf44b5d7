"""Landed files, streams and models over the test tables."""

from __future__ import annotations

import json
from functools import cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators import ml, nested, rules, store
from ..operators.columns import named
from ..operators.features import score_features
from ..schemas import EVENT_MESSAGE
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources import external, faers, landing
from ..streaming import events as E
from ..streaming import jobs
from . import oracle as O
from .profile_queries import _ALERT_ROW, _ALERT_ROW_SQL, _MESSAGE_SQL, _MINUTE_SQL, _SPLIT_SIZES
from .registry import query
from .report_queries import ID, stored_training
from .tables import EVENT_FIELDS, EVENT_STORE, RULE_EVENTS, SCORED_EVENTS, Tables


# Landed files

@query("read_report_pages", O.using("reports", body="""
SELECT safetyreportid, serious, receivedate, patientonsetage, medicinalproduct FROM reports"""))
def read_report_pages(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "report-pages")
    t.reports_nested.select(F.array(F.struct("*")).alias("results")).write.json(path)
    reports = landing.read_report_pages(t.spark, path, multiline=False)
    return reports.select(
        ID, "serious", "receivedate", "patient.patientonsetage",
        F.get("patient.drug", 0)["medicinalproduct"].alias("medicinalproduct"))


_PAGE_FIELDS = ["sender.senderorganization", "openfda.route.code", "openfda.route.count", "patient.summary.narrative",
                "patient.patientonsetage", "fulfillexpeditecriteria"]


@query("pages_all_fields", O.using("reports_listed", body="""
SELECT safetyreportid, primarysourcecountry AS "sender.senderorganization",
  CASE WHEN CAST(safetyreportid AS BIGINT) % 3 = 0 THEN serious END AS "openfda.route.code",
  CASE WHEN CAST(safetyreportid AS BIGINT) % 3 = 0 THEN CAST(safetyreportid AS BIGINT) % 7 END AS "openfda.route.count",
  concat('case ', safetyreportid) AS "patient.summary.narrative", patientonsetage AS "patient.patientonsetage",
  CASE WHEN CAST(safetyreportid AS BIGINT) % 2 = 0 THEN concat('"', receivedate, '"') ELSE '1' END AS fulfillexpeditecriteria,
  CAST(COALESCE(len(drugs), 0) AS INTEGER) AS drugs FROM reports_listed"""))
def pages_all_fields(t: Tables) -> DataFrame:
    """Pages of up to fifty reports with fields that no schema declares, some of them in part of the reports only, and one
    that is a number here and a text there."""
    path = scratch_dir(t.spark, "report-pages")
    number = F.col(ID).cast("bigint")
    route = F.struct(F.col("serious").alias("code"), (number % 7).alias("count"))
    reports = t.reports_nested.withColumns({
        "sender": F.struct(F.col("primarysourcecountry").alias("senderorganization")),
        "openfda": F.when(number % 3 == 0, F.struct(route.alias("route"))),
        "patient": F.col("patient").withField("summary", F.struct(F.concat(F.lit("case "), F.col(ID)).alias("narrative"))),
        "fulfillexpeditecriteria": F.parse_json(
            F.when(number % 2 == 0, F.concat(F.lit('"'), F.col("receivedate"), F.lit('"'))).otherwise("1")),
    })
    pages = reports.groupBy(F.floor(number / 50).alias("page")).agg(F.collect_list(F.struct(*reports.columns)).alias("results"))
    pages.select("results").write.json(path)
    flat = nested.normalize_records(landing.read_page_records(t.spark, path, multiline=False))
    return flat.select(ID, *[named(c) for c in _PAGE_FIELDS], F.size(named("patient.drug")).alias("drugs"))


@query("read_study_pages", O.using("study_records", body="""
SELECT nctId, phase, startDate, enrollment, interventions, conditions FROM study_records"""))
def read_study_pages(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "study-pages")
    t.studies_nested.select(F.array(F.struct("*")).alias("studies")).write.json(path)
    studies = landing.read_study_pages(t.spark, path, multiline=False)
    return nested.study_records(studies).select("nctId", "phase", "startDate", "enrollment", "interventions", "conditions")


_DEMO = ["primaryid", "occr_country", "event_dt", "age"]
_DELIMITED = {"quote": "", "header": True, "sep": "\x01", "emptyValue": "", "encoding": "UTF-8"}


def _every(n: int, rest: int = 0) -> Column:
    return F.col(ID).cast("bigint") % n == rest


def _demo_lines(reports: DataFrame, order: list[str]) -> DataFrame:
    """Text rows with the columns in the given order: every 43rd has a field too many, every 47th lacks its last two."""
    source = {"primaryid": ID, "occr_country": "occurcountry", "event_dt": "receivedate", "age": "patientonsetage", "sex": "serious"}
    fields = [F.coalesce(F.col(source[c.lower()]), F.lit("")) for c in order]
    full = F.concat_ws("$", *fields)
    line = (
        F.when(_every(43), F.concat(full, F.lit("$surplus")))
        .when(_every(47), F.concat_ws("$", *fields[:-2]))
        .otherwise(full)
    )
    return reports.select(line.alias("$".join(order)))


@query("read_faers_text", O.using("reports", body="""
SELECT safetyreportid AS primaryid, occurcountry AS occr_country,
  CASE WHEN CAST(safetyreportid AS BIGINT) % 4 = 1 OR CAST(safetyreportid AS BIGINT) % 47 <> 0 THEN receivedate END AS event_dt,
  CASE WHEN CAST(safetyreportid AS BIGINT) % 47 <> 0 THEN patientonsetage END AS age
FROM reports WHERE CAST(safetyreportid AS BIGINT) % 43 <> 0"""))
def read_faers_text(t: Tables) -> DataFrame:
    """Three quarters: even reports in one order of columns, odd ones in two others, with a column more."""
    root = scratch_dir(t.spark, "faers-text")
    _demo_lines(t.reports.where(_every(2)), _DEMO).write.options(**_DELIMITED).csv(f"{root}/q1")
    for rest, other in ((1, ["event_dt", "primaryid", "occr_country", "sex", "age"]),
                        (3, ["sex", "PRIMARYID", "Occr_Country", "event_dt", "age"])):
        lines = _demo_lines(t.reports.where(_every(4, rest)), other)
        lines.write.options(**_DELIMITED).csv(f"{root}/q{1 + rest}")
    return faers.read_text_table(t.spark, [f"{root}/q{k}" for k in (1, 2, 4)], _DEMO)


@query("faers_members", O.using("reports", body="""
SELECT CASE CAST(safetyreportid AS BIGINT) % 3 WHEN 0 THEN 'faers_ascii_2024q1' ELSE 'faers_ascii_2024q2' END AS archive,
  safetyreportid AS primaryid, occurcountry AS occr_country
FROM reports WHERE CAST(safetyreportid AS BIGINT) % 43 <> 0 AND CAST(safetyreportid AS BIGINT) % 3 <> 2"""))
def faers_members(t: Tables) -> DataFrame:
    """Rows of the demographic members of two archives; a later member and other tables lie beside them."""
    root = scratch_dir(t.spark, "faers-archives")
    for rest, member in ((0, "faers_ascii_2024q1/DEMO24Q1.txt"), (1, "faers_ascii_2024q2/demo24q2.txt"),
                         (2, "faers_ascii_2024q2/demo24q2_old.txt")):
        _demo_lines(t.reports.where(_every(3, rest)), _DEMO).write.options(**_DELIMITED).csv(f"{root}/{member}")
    t.outcomes.write.options(sep="$", header=True).csv(f"{root}/faers_ascii_2024q1/OUTC24Q1.txt")
    return faers.read_members(t.spark, root, "DEMO", ["primaryid", "occr_country"])


_ODD_TEXTS = [" both ends ", "", "say \"hi\", twice", "two\nlines", "a,b", "back\\slash"]


@query("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents UNION ALL SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({-1 - i} AS BIGINT), '{text}', CAST(NULL AS VARCHAR), '', CAST({len(text)} AS BIGINT))"
    for i, text in enumerate(_ODD_TEXTS)) + ") odd(doc_id, text, lang, source, n_chars)")
def csv_round_trip(t: Tables) -> DataFrame:
    """Documents, and rows with blanks at both ends, empty and missing text, quotes and line breaks."""
    odd = [(-1 - i, text, None, "", len(text)) for i, text in enumerate(_ODD_TEXTS)]
    docs = t.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.unionByName(t.spark.createDataFrame(odd, docs.schema))
    path = landing.zone_path(scratch_dir(t.spark, "zones"), "raw", "documents.csv")
    landing.write_csv(rows, path)
    return landing.read_csv(t.spark, path, rows.schema)


# Streams

def _event_stream(t: Tables) -> DataFrame:
    schema = t.table("events").schema
    return E.read_event_files(t.spark, t.folder, schema, pathGlobFilter="events.parquet")


def _stream_input(t: Tables, text: str) -> DataFrame:
    """A derived input over the event stream instead of the event table, with an instant as event time."""
    stream = t.spark.sql(text, events=_event_stream(t))
    return stream.withColumns({c: named(c).cast("timestamp") for c in ("ts", "created_at") if c in stream.columns})


def _messages(t: Tables) -> DataFrame:
    """Event messages as a topic delivers them; every 50th value is cut off and so is no JSON."""
    fields = [f.name for f in EVENT_MESSAGE.fields if f.name != "timestamp"]
    numbered = _stream_input(t, EVENT_FIELDS)
    value = F.to_json(F.struct(*fields))
    broken = F.when(F.col("n") % 50 == 0, F.substring(value, 1, 20)).otherwise(value)
    return numbered.select(F.concat(F.lit("safety_report_"), F.col(ID)).alias("key"), broken.alias("value"))


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query("stream_read_events", O.using("event_store", body="SELECT event_id, safetyreportid, receivedate, serious FROM event_store"))
def stream_read_events(t: Tables) -> DataFrame:
    stream = _stream_input(t, EVENT_STORE).select("event_id", ID, "receivedate", "serious")
    return jobs.drained(stream, "stream-read")


_PARSED = ["event_id", "safetyreportid", "is_serious", "source", "drug_count", "outcome_severity"]


@query("stream_parse", O.using("event_fields", body=f"""
SELECT concat('safety_report_', safetyreportid) AS key, {', '.join(_PARSED)} FROM event_fields WHERE n % 50 <> 0"""))
def stream_parse(t: Tables) -> DataFrame:
    parsed = E.readable_events(E.parse_messages(_messages(t)))
    return jobs.drained(parsed.select("key", *_PARSED), "stream-parse")


@query("stream_dead_letters", O.using("event_fields", body="""
SELECT concat('safety_report_', safetyreportid) AS key FROM event_fields WHERE n % 50 = 0"""))
def stream_dead_letters(t: Tables) -> DataFrame:
    return jobs.drained(E.dead_letters(E.parse_messages(_messages(t))).select("key"), "stream-dead")


@query("stream_features", O.using("event_fields", body="SELECT event_id, " + ", ".join(
    f"COALESCE(CASE WHEN isnan(try_cast({c} AS DOUBLE)) THEN NULL ELSE try_cast({c} AS DOUBLE) END, 0) AS {c}"
    for c in K.MODEL_FEATURES) + " FROM event_fields WHERE n % 50 <> 0"))
def stream_features(t: Tables) -> DataFrame:
    events = E.readable_events(E.parse_messages(_messages(t)))
    return jobs.drained(score_features(events).select("event_id", *K.MODEL_FEATURES), "stream-features")


@query("stream_envelope", """
SELECT printf('AE_%06d', event_id) AS event_id, 'FDA_FAERS_STREAM' AS source,
  CAST(floor((epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01 00:00:00') // 1000000) / 60) + 1 AS INTEGER) AS stream_batch,
  concat('safety_report_', CAST(user_id AS VARCHAR)) AS key FROM events""")
def stream_envelope(t: Tables) -> DataFrame:
    rows = t.table("events").select(
        F.col("event_id").alias("n"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias(ID))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return E.envelope(rows, F.col("n"), F.col("ts"), start).select("event_id", "source", "stream_batch", "key")


@query("stream_write_alerts", O.using("scored_events", body="""
SELECT concat('ALERT_', event_id) AS key, concat('ALERT_', event_id) AS alert_id FROM scored_events WHERE prediction = 1"""))
def stream_write_alerts(t: Tables) -> DataFrame:
    """Alert messages as the alert topic takes them, written to the file sink."""
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    messages = external.as_messages(E.model_alerts(_stream_input(t, SCORED_EVENTS), stamp), F.col("alert_id"))
    written = jobs.drained(messages, "stream-alert-messages")
    return written.select(F.col("key").cast("string").alias("key"),
                          F.get_json_object(F.col("value").cast("string"), "$.alert_id").alias("alert_id"))


@query("stream_given_alerts", O.using("scored_events", body=f"""
SELECT concat('ALERT_', event_id) AS alert_id, CAST(outcome_severity AS DOUBLE) AS outcome_severity, drug_count,
  patient_risk_score, 'UNKNOWN' AS source, 1 AS predicted_serious, confidence_serious,
  {O.yes('GREATEST(confidence_serious, CAST(1 AS DOUBLE) - confidence_serious) > CAST(0.8 AS DOUBLE)')} AS high_confidence,
  CASE WHEN confidence_serious > CAST(0.9 AS DOUBLE) THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level,
  {O.yes('confidence_serious > CAST(0.8 AS DOUBLE)')} AS requires_review, {_MESSAGE_SQL} AS alert_message
FROM scored_events WHERE prediction = 1"""))
def stream_given_alerts(t: Tables) -> DataFrame:
    """Nested alerts of a stream whose probabilities are given."""
    alerts = jobs.drained(E.model_alerts(_stream_input(t, SCORED_EVENTS)), "stream-given-alerts")
    return alerts.select(
        "alert_id", "original_event.outcome_severity", "original_event.drug_count", "original_event.patient_risk_score",
        "original_event.source", "ml_prediction.predicted_serious", "ml_prediction.confidence_serious",
        "ml_prediction.high_confidence", "alert_level", "requires_review", "alert_message")


@query("stream_dedupe", O.using("event_store", body="SELECT event_id, safetyreportid, serious FROM event_store"))
def stream_dedupe(t: Tables) -> DataFrame:
    """Every event arrives twice."""
    once = _stream_input(t, EVENT_STORE)
    again = _stream_input(t, EVENT_STORE)
    unique = E.dedupe(once.unionByName(again), "created_at", "1 hour", salts=8)
    return jobs.drained(unique.select("event_id", ID, "serious"), "stream-dedupe")


@query("stream_dedupe_state", O.using("event_store", body="""
SELECT COUNT(*) AS events, COUNT(*) AS dropped, TRUE AS outside_heap, TRUE AS changes_logged FROM event_store"""))
def stream_dedupe_state(t: Tables) -> DataFrame:
    """Every event arrives twice: events kept, repeats dropped, and where the stream keeps the ids it has seen."""
    base = scratch_dir(t.spark, "stream-dedupe-state")
    once, again = (_stream_input(t, EVENT_STORE).select("event_id", "created_at") for _ in range(2))
    unique = E.dedupe(once.unionByName(again), "created_at", "1 hour")
    run = jobs.drain_to_parquet(unique, f"{base}/out", f"{base}/checkpoint")
    steps = [step for progress in run.recentProgress for step in json.loads(progress.json)["stateOperators"]]
    metrics = [step["customMetrics"] for step in steps]
    kept = t.spark.read.schema(unique.schema).parquet(f"{base}/out")
    logged = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.changelog").option("recursiveFileLookup", True).load(
        f"{base}/checkpoint/state").limit(1).count()  # files of the checkpoint, not rows of the stream
    return kept.agg(F.count(F.lit(1)).alias("events")).select(
        "events", F.lit(sum(m.get("numDroppedDuplicateRows", 0) for m in metrics)).cast("bigint").alias("dropped"),
        F.lit(bool(metrics) and all(any(name.startswith("rocksdb") for name in m) for m in metrics)).alias("outside_heap"),
        F.lit(logged > 0).alias("changes_logged"))


_CLOSED_SQL = """WITH early AS (SELECT * FROM event_store WHERE CAST(event_id AS BIGINT) % 10 <> 0),
edge AS (SELECT date_trunc('millisecond', max(created_at)) - INTERVAL 10 MINUTE AS at FROM early),
late AS (SELECT COUNT(*) AS n FROM event_store, edge WHERE CAST(event_id AS BIGINT) % 10 = 0 AND created_at <= edge.at)
SELECT date_trunc('minute', created_at) AS minute, COUNT(*) AS events,
  COUNT(*) FILTER (WHERE serious = 1) AS serious_events,
  round(COUNT(*) FILTER (WHERE serious = 1) * CAST(100 AS DOUBLE) / COUNT(*), 6) AS serious_percent, any_value(late.n) AS late
FROM early, edge, late WHERE date_trunc('minute', created_at) + INTERVAL 1 MINUTE <= edge.at GROUP BY 1"""


@query("stream_closed_minutes", O.using("event_store", body="SELECT * FROM (" + _CLOSED_SQL + ")"))
def stream_closed_minutes(t: Tables) -> DataFrame:
    """Each minute once, when the watermark has passed it. Every tenth event arrives in a second run, when most minutes are
    closed: these are dropped and counted. The minutes of the last ten are not closed yet."""
    base = scratch_dir(t.spark, "stream-closed")
    events, tenth = t.event_store, F.col("event_id").cast("bigint") % 10 == 0
    schema = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("serious", T.IntegerType()),
                           T.StructField("created_at", T.TimestampType())])
    late = 0
    for part in (events.where(~tenth), events.where(tenth)):
        part.select("event_id", "serious", F.col("created_at").cast("timestamp").alias("created_at")).write.mode(
            "append").parquet(f"{base}/in")
        unique = E.dedupe(E.read_event_files(t.spark, f"{base}/in", schema), "created_at", "10 minutes")
        minutes = E.closed_minutes(unique, "created_at")
        with jobs.run_stats(t.spark) as stats:
            jobs.drain_to_parquet(minutes, f"{base}/out", f"{base}/checkpoint")
        late += stats.late
    closed = t.spark.read.schema(minutes.schema).parquet(f"{base}/out")
    return _ntz(closed, "minute").withColumn("late", F.lit(late).cast("bigint"))


@query("stream_minute_summary", O.using("event_store", body=_MINUTE_SQL))
def stream_minute_summary(t: Tables) -> DataFrame:
    """Minutes as updated by the stream, the last update of each kept; no minute waits for a watermark."""
    base = scratch_dir(t.spark, "stream-minutes")
    summary = E.windowed_minutes(_stream_input(t, EVENT_STORE), "created_at", "10 minutes")
    return _ntz(jobs.drain_updates(summary, base, key="minute"), "minute")


@query("stream_rule_alerts", O.using("ruled_events", body=
       _ALERT_ROW_SQL + " FROM ruled_events WHERE risk_score >= CAST(0.5 AS DOUBLE)"))
def stream_rule_alerts(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "stream-rules")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    jobs.store_rule_alerts(_stream_input(t, RULE_EVENTS), f"{base}/store", f"{base}/checkpoint", now)
    return store.read_table(t.spark, f"{base}/store", "safety_alerts").select(*_ALERT_ROW)


@query("stream_two_writers", O.using("event_store", body="SELECT event_id FROM event_store"))
def stream_two_writers(t: Tables) -> DataFrame:
    """Two streams with checkpoints of their own, which number their batches alike, fill one store."""
    base = scratch_dir(t.spark, "stream-writers")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    events = _stream_input(t, EVENT_STORE)
    for rest in (0, 1):
        part = events.where(F.col("event_id").cast("bigint") % 2 == rest).select("event_id", ID)
        jobs.store_rule_alerts(part, f"{base}/store", f"{base}/checkpoint-{rest}", now)
    return store.read_table(t.spark, f"{base}/store", "adverse_events").select("event_id")


_PHASE_SQL = """SELECT '{0}' AS phase, COUNT(*) AS events, COUNT(*) FILTER (WHERE risk_score >= CAST(0.5 AS DOUBLE)) AS alerts,
  CAST(0 AS BIGINT) AS alerts_missing, CAST(0 AS BIGINT) AS orphans FROM ruled_events WHERE {1}"""


@query("stream_crash_between_tables", O.using("ruled_events", body=" UNION ALL ".join([
    _PHASE_SQL.format("crashed", "CAST(event_id AS BIGINT) % 2 = 0"), _PHASE_SQL.format("restarted", "TRUE")])))
def stream_crash_between_tables(t: Tables) -> DataFrame:
    """A store job that dies with the rows of both tables written and its batch not committed: the store shows neither
    events nor alerts of that batch, and both after a restart."""
    base = scratch_dir(t.spark, "stream-crash")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = t.rule_events

    def run(before_commit=None) -> None:
        stream = E.read_event_files(t.spark, f"{base}/in", rows.schema)
        jobs.store_rule_alerts(stream, f"{base}/store", f"{base}/checkpoint", now, "crash", before_commit)

    def die() -> None:
        raise RuntimeError("the job dies between write and commit")

    def phase(name: str) -> DataFrame:
        events, alerts = (store.read_table(t.spark, f"{base}/store", n) for n in store.DAILY)
        serious = events.join(ruled, "event_id").where("risk >= 0.5").select("event_id")
        counts = [events.agg(F.count(F.lit(1))), alerts.agg(F.count(F.lit(1))),
                  serious.join(alerts, "event_id", "left_anti").agg(F.count(F.lit(1))),
                  alerts.join(events, "event_id", "left_anti").agg(F.count(F.lit(1)))]
        names = ["events", "alerts", "alerts_missing", "orphans"]
        return t.spark.range(1).select(F.lit(name).alias("phase"), *[c.scalar().alias(n) for c, n in zip(counts, names)])

    ruled = rules.assessed_with_source(rows).select("event_id", F.col("risk_score").alias("risk"))
    number = F.col("event_id").cast("bigint")
    rows.where(number % 2 == 0).write.parquet(f"{base}/in")
    run()
    rows.where(number % 2 == 1).write.mode("append").parquet(f"{base}/in")
    try:
        run(die)
    except StreamingQueryException:
        crashed = phase("crashed")
    else:
        raise RuntimeError("the failure was not noticed")
    run()
    return crashed.unionByName(phase("restarted"))


@query("stream_bounded_run", O.using("event_store", body="""
SELECT TRUE AS enough, TRUE AS stopped_in_time, CAST(0 AS BIGINT) AS strangers"""))
def stream_bounded_run(t: Tables) -> DataFrame:
    """Events split over twenty files, one read every two seconds until a quarter is written: at least a quarter comes, no file
    after the one that reaches it, and no event that was not sent."""
    base = scratch_dir(t.spark, "stream-bounded")
    t.event_store.repartition(20).write.parquet(f"{base}/in")
    schema = t.event_store.schema
    sent = t.spark.read.schema(schema).parquet(f"{base}/in")
    quarter = sent.count() // 4
    limit = max(quarter, 1)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    stream = E.read_event_files(t.spark, f"{base}/in", schema, maxFilesPerTrigger=1)
    jobs.run_limited(stream, write, f"{base}/checkpoint", limit, idle_seconds=20, poll_seconds=0.1, processingTime="2 seconds")
    got = t.spark.read.schema(schema).parquet(f"{base}/out")
    largest = sent.groupBy(F.input_file_name()).count().agg(F.coalesce(F.max("count"), F.lit(0)))
    known = got["event_id"].eqNullSafe(t.event_store["event_id"])
    strangers = got.join(t.event_store, known, "left_anti").agg(F.count(F.lit(1)))
    return got.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") >= quarter).alias("enough"),
        # Fewer than the limit came before the last file.
        (F.col("n") < limit + largest.scalar()).alias("stopped_in_time"), strangers.scalar().alias("strangers"))


# Models

class _Workspace:
    """Training table and models of one session and folder, written once to the shared folder.

    The tables' classes are drawn at random, which no model can learn; the models here are trained to tell the reports of
    four drugs and more.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.root = scratch_dir(spark, "models")
        self.training_path = f"{self.root}/training"
        learnable = (F.col("drug_count") >= 4).cast("int")
        table = ml.with_split(stored_training(Tables(spark, folder)).withColumn(ml.LABEL, learnable))
        table.write.partitionBy("split").parquet(self.training_path)
        self.trained = ml.TrainedModels()

    def part(self, split: str) -> DataFrame:
        return self.spark.read.parquet(self.training_path).where(F.col("split") == split)

    def model(self, name: str):
        import time

        if name not in self.trained.models:
            train = self.part("train")
            build = {
                ml.RANDOM_FOREST: lambda: ml.random_forest(ml.feature_columns(train)),
                ml.GRADIENT_BOOSTING: lambda: ml.gradient_boosting(ml.feature_columns(train)),
                ml.LOGISTIC: lambda: ml.logistic(train.count(), ml.feature_columns(train)),
            }[name]
            started = time.monotonic()
            self.trained.models[name] = ml.fit(build(), train)
            self.trained.seconds[name] = time.monotonic() - started
        return self.trained.models[name]

    def all_models(self) -> ml.TrainedModels:
        for name in (ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING, ml.LOGISTIC):
            self.model(name)
        names = (ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING, ml.LOGISTIC)
        return ml.TrainedModels({n: self.trained.models[n] for n in names}, dict(self.trained.seconds))


@cache
def _workspace(application: str, folder: str) -> _Workspace:
    spark = SparkSession.active()
    ensure_checkpoint_dir(spark)
    return _Workspace(spark, folder)


def _models(t: Tables) -> _Workspace:
    return _workspace(t.spark.sparkContext.applicationId, t.folder)


def prepare_models(t: Tables) -> None:
    """Write the training table that all model queries read."""
    _models(t)


def _validated(t: Tables, name: str) -> DataFrame:
    """Validation of one freshly or earlier trained model: rows, and whether it beats calling every report by the larger class,
    in accuracy and by at least 0.05 in F1."""
    work = _models(t)
    scored = ml.score(work.model(name), work.part("validation"))
    share = work.part("validation").agg(F.avg(ml.LABEL)).scalar()
    larger = F.greatest("share", 1 - F.col("share"))
    majority_f1 = F.when(F.col("share") >= 0.5, 2 * F.col("share") / (1 + F.col("share"))).otherwise(0.0)
    return ml.classification_metrics(scored).withColumn("share", share).select(
        F.lit(name).alias("model_name"), "rows",
        ((F.col("f1_score") >= majority_f1 + 0.05) & (F.col("accuracy") > larger)).alias("beats_majority"))


# The target of the models, and how many of its rows go where.
_LEARNABLE = "SELECT * REPLACE (CASE WHEN drug_count >= 4 THEN 1 ELSE 0 END AS is_serious) FROM training"
_LEARNABLE_SIZES = {"learnable": _LEARNABLE, "sizes": _SPLIT_SIZES.replace("FROM training", "FROM learnable")}


def _trained_sql(name: str) -> str:
    return O.using("training", extra=_LEARNABLE_SIZES, body=f"""
SELECT '{name}' AS model_name, CAST(sum(validation) AS BIGINT) AS rows, TRUE AS beats_majority FROM sizes""")


@query("train_random_forest", _trained_sql(ml.RANDOM_FOREST))
def train_random_forest(t: Tables) -> DataFrame:
    return _validated(t, ml.RANDOM_FOREST)


@query("train_gbt", _trained_sql(ml.GRADIENT_BOOSTING))
def train_gbt(t: Tables) -> DataFrame:
    return _validated(t, ml.GRADIENT_BOOSTING)


@query("train_logistic", _trained_sql(ml.LOGISTIC))
def train_logistic(t: Tables) -> DataFrame:
    return _validated(t, ml.LOGISTIC)


_MODEL_NAMES = [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING, ml.LOGISTIC]


def _name_rows(columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS model_name, {columns}" for n in _MODEL_NAMES)


@query("evaluate_models", _name_rows("TRUE AS counts_agree, TRUE AS auc_agrees"))
def evaluate_models(t: Tables) -> DataFrame:
    """Whether accuracy equals that of counted predictions, and the AUC the share of rightly ordered pairs by ranks."""
    work = _models(t)
    out = None
    for row in ml.evaluate(work.all_models(), work.part("test")).collect():  # one row per model
        scored = ml.score(work.model(row.model_name), work.part("test"))
        by_score = scored.groupBy("confidence_serious").agg(
            F.count_if(F.col(ml.LABEL) == 1).alias("p"), F.count_if(F.col(ml.LABEL) == 0).alias("n"),
            F.count_if(F.col(ml.LABEL) == F.col("prediction")).alias("hit"))
        # Equal scores share their places; pairs of them count half. One row per distinct score, in one check.
        below = F.sum("n").over(Window.orderBy("confidence_serious")) - F.col("n")
        sums = by_score.withColumn("pairs", F.col("p") * (below + F.col("n") / 2)).agg(
            F.sum("pairs").alias("pairs"), F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum("hit").alias("hit"))
        one = sums.select(
            F.lit(row.model_name).alias("model_name"),
            (F.abs(F.col("hit") / (F.col("p") + F.col("n")) - row.accuracy) < 1e-6).alias("counts_agree"),
            (F.abs(F.col("pairs") / (F.col("p") * F.col("n")) - row.roc_auc) < 1e-6).alias("auc_agrees"))
        out = one if out is None else out.unionByName(one)
    return out


@query("best_model", "SELECT TRUE AS has_highest_f1, CAST(1 AS BIGINT) AS rows")
def best_model(t: Tables) -> DataFrame:
    work = _models(t)
    metrics = ml.evaluate(work.all_models(), work.part("test"))
    highest = metrics.agg(F.max("f1_score")).scalar()
    return ml.best_model(metrics).agg(F.bool_and(F.col("f1_score") == highest).alias("has_highest_f1"),
                                      F.count(F.lit(1)).alias("rows"))


@query("feature_importance", "SELECT CAST(14 AS BIGINT) AS features, TRUE AS sums_to_one, TRUE AS top_ten_in_order")
def feature_importance(t: Tables) -> DataFrame:
    model = _models(t).model(ml.RANDOM_FOREST)
    top = [r.importance for r in ml.feature_importance(model).collect()]  # ten rows
    return ml.feature_importance(model, top=None).agg(
        F.count_distinct("feature").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        F.lit(len(top) == 10 and top == sorted(top, reverse=True)).alias("top_ten_in_order"))


@query("record_model_performance", " UNION ALL ".join(
    f"SELECT '{n}' AS model_name, {str(n != ml.LOGISTIC).upper()} AS has_importances" for n in _MODEL_NAMES))
def record_model_performance(t: Tables) -> DataFrame:
    work = _models(t)
    models = work.all_models()
    rows = ml.performance_rows(ml.evaluate(models, work.part("test")), ml.importances(models), F.current_timestamp())
    root = scratch_dir(t.spark, "store")
    store.create_tables(t.spark, root, ["model_performance"])
    store.append_batch(store.conform(rows, "model_performance"), root, "model_performance", 0)
    stored = store.read_table(t.spark, root, "model_performance")
    return stored.select("model_name", F.col("feature_importance").isNotNull().alias("has_importances"))


@query("model_round_trip", O.using("training", extra=_LEARNABLE_SIZES, body="SELECT TRUE AS equal, CAST(sum(test) AS BIGINT) AS rows FROM sizes"))
def model_round_trip(t: Tables) -> DataFrame:
    """Predictions of the saved and reloaded pipeline next to those of the one in memory."""
    work = _models(t)
    root = scratch_dir(t.spark, "saved-models")
    trained = ml.TrainedModels({ml.LOGISTIC: work.model(ml.LOGISTIC)})
    ml.save_models(trained, root)
    test = work.part("test")
    before = ml.score(work.model(ml.LOGISTIC), test).select(ID, F.col("confidence_serious").alias("before"))
    after = ml.score(ml.load_model(root, ml.LOGISTIC), test).select(ID, F.col("confidence_serious").alias("after"))
    return before.join(after, ID).agg(F.bool_and(F.col("before") == F.col("after")).alias("equal"), F.count(F.lit(1)).alias("rows"))


def _consistent(scored: DataFrame) -> DataFrame:
    """Per event, whether label, flag and probabilities fit one another."""
    p, q = F.col("confidence_serious"), F.col("confidence_non_serious")
    return scored.select(
        "event_id", (F.abs(p + q - 1) < 1e-9).alias("sums_to_one"), (F.col("prediction") == (p > q).cast("int")).alias("likelier_class"),
        (F.col("high_confidence") == (F.greatest(p, q) > 0.8).cast(scored.schema["high_confidence"].dataType)).alias("flag_fits"))


@query("score_events", O.using("event_fields", body=
       "SELECT event_id, TRUE AS sums_to_one, TRUE AS likelier_class, TRUE AS flag_fits FROM event_fields"))
def score_events(t: Tables) -> DataFrame:
    return _consistent(ml.score(_models(t).model(ml.GRADIENT_BOOSTING), t.event_fields))


def _scored_stream(t: Tables) -> DataFrame:
    events = E.readable_events(E.parse_messages(_messages(t)))
    return ml.score(_models(t).model(ml.GRADIENT_BOOSTING), events)


@query("stream_score", O.using("event_fields", body="SELECT event_id, TRUE AS as_in_batch FROM event_fields WHERE n % 50 <> 0"))
def stream_score(t: Tables) -> DataFrame:
    """Streamed scores next to those of the same events in one batch."""
    streamed = jobs.drained(_scored_stream(t).select("event_id", "prediction", "confidence_serious"), "stream-score")
    batch = ml.score(_models(t).model(ml.GRADIENT_BOOSTING), t.event_fields).select(
        "event_id", F.col("prediction").alias("p"), F.col("confidence_serious").alias("c"))
    same = (F.col("prediction") == F.col("p")) & (F.abs(F.col("confidence_serious") - F.col("c")) < 1e-12)
    return streamed.join(batch, "event_id").select("event_id", same.alias("as_in_batch"))


@query("stream_alerts", "SELECT TRUE AS one_per_serious_event, CAST(0 AS BIGINT) AS strangers")
def stream_alerts(t: Tables) -> DataFrame:
    """Alerts of the streamed model next to the events that it calls serious in one batch."""
    alerts = jobs.drained(E.model_alerts(_scored_stream(t)), "stream-alerts").select(
        F.regexp_replace("alert_id", "^ALERT_", "").alias("event_id"))
    scored = ml.score(_models(t).model(ml.GRADIENT_BOOSTING), t.event_fields)
    serious = scored.where((F.col("prediction") == 1) & (F.col("n") % 50 != 0)).select("event_id")
    strangers = alerts.join(serious, "event_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    return serious.join(alerts.groupBy("event_id").count(), "event_id", "left").agg(
        F.bool_and(F.coalesce(F.col("count") == 1, F.lit(False))).alias("one_per_serious_event")).select(
        F.coalesce("one_per_serious_event", F.lit(True)).alias("one_per_serious_event"), strangers.alias("strangers"))


@query("stream_stats", O.using("scored_events", body="""
SELECT COUNT(*) AS processed, SUM(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS serious_predicted,
  SUM(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS alerts_sent,
  round(SUM(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) / COUNT(*), 6) AS serious_percent FROM scored_events"""))
def stream_stats(t: Tables) -> DataFrame:
    """Totals over more micro-batches than a query keeps reports of: given probabilities, one file per trigger."""
    base = scratch_dir(t.spark, "stream-stats")
    t.scored_events.repartition(101).write.parquet(f"{base}/in")
    stream = E.read_event_files(t.spark, f"{base}/in", t.scored_events.schema, maxFilesPerTrigger=1)
    with jobs.run_stats(t.spark) as stats:
        jobs.drain_to_parquet(E.with_stats(stream).select("event_id", "prediction"), f"{base}/out", f"{base}/checkpoint")
    totals = stats.totals()
    names = ["processed", "serious_predicted", "alerts_sent"]
    return t.spark.createDataFrame([tuple(totals[n] for n in names) + (round(totals["serious_percent"], 6),)],
                                   ", ".join(f"{n} long" for n in names) + ", serious_percent double")


@query("stream_durable_stats", O.using("scored_events", body="""
SELECT run, COUNT(*) AS processed, COUNT(*) FILTER (WHERE prediction = 1) AS serious_predicted,
  COUNT(*) FILTER (WHERE prediction = 1) AS alerts_sent,
  round(COUNT(*) FILTER (WHERE prediction = 1) * CAST(100 AS DOUBLE) / COUNT(*), 6) AS serious_percent
FROM scored_events, (VALUES ('stopped', 2), ('restarted', 1)) runs(run, n) WHERE CAST(event_id AS BIGINT) % n = 0 GROUP BY run"""))
def stream_durable_stats(t: Tables) -> DataFrame:
    """Totals of a stream that stops after half of the events and goes on from its checkpoint, with a batch that fails after
    its rows are written and is tried again."""
    base = scratch_dir(t.spark, "stream-durable")
    events, half, out = t.scored_events, F.col("event_id").cast("bigint") % 2 == 0, []
    failures = [1]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")
        if batch_id == 3 and failures:
            failures.pop()
            raise RuntimeError("the job dies behind its write")

    counted = jobs.with_durable_stats(write, f"{base}/stats")
    for run, part in (("stopped", events.where(half)), ("restarted", events.where(~half))):
        part.repartition(3).write.mode("append").parquet(f"{base}/in")
        stream = E.read_event_files(t.spark, f"{base}/in", events.schema, maxFilesPerTrigger=1)
        try:
            jobs.drain_batches(stream, counted, f"{base}/checkpoint")
        except StreamingQueryException:
            jobs.drain_batches(stream, counted, f"{base}/checkpoint")
        totals = jobs.durable_stats(t.spark, f"{base}/stats")
        out.append((run, totals["processed"], totals["serious_predicted"], totals["alerts_sent"], round(totals["serious_percent"], 6)))
    return t.spark.createDataFrame(
        out, "run string, processed long, serious_predicted long, alerts_sent long, serious_percent double")
