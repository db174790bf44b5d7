"""Transformations on event streams; each also runs on a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import alerts
from ..operators.columns import evaluated_once, named, number
from ..schemas import EVENT_MESSAGE

# Field that tells a message which is JSON from one which is not; never part of a message itself.
_BAD = "_unreadable"


def read_event_files(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.format("parquet").schema(schema).options(**options).load(path)


def parse_messages(messages: DataFrame, schema: T.StructType = EVENT_MESSAGE) -> DataFrame:
    """Messages with the parsed ``event`` and whether their value was a ``readable`` JSON object."""
    full = T.StructType(schema.fields + [T.StructField(_BAD, T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    once = evaluated_once(messages, {"parsed": parsed})
    event = F.struct(*[F.col(f"parsed.{f.name}").alias(f.name) for f in schema.fields])
    readable = F.col("parsed").isNotNull() & F.col(f"parsed.{_BAD}").isNull()
    return once.select(*messages.columns, event.alias("event"), readable.alias("readable"))


def readable_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("readable").select("key", "event.*")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that could not be read, for a sink of their own."""
    return parsed.where("NOT readable").select("key", "value")


def envelope(events: DataFrame, number_column: Column, ts: Column, stream_start: Column) -> DataFrame:
    """Stream metadata of an event: time, id, source, minute of the stream and message key."""
    minute = F.floor((F.unix_seconds(ts) - F.unix_seconds(stream_start)) / 60) + 1
    return events.withColumns({
        "timestamp": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "event_id": F.format_string("AE_%06d", number_column),
        "source": F.lit(K.STREAM_SOURCE),
        "stream_batch": minute.cast("int"),
        "key": F.concat(F.lit("safety_report_"), F.coalesce(named("safetyreportid").cast("string"), number_column.cast("string"))),
    })


def serious_gate(scored: DataFrame) -> DataFrame:
    """Events the model predicts to be serious."""
    return scored.where(F.col("prediction") == 1)


def _text(df: DataFrame, name: str) -> Column:
    value = named(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    return F.coalesce(value, F.lit("UNKNOWN"))


def _num(df: DataFrame, name: str) -> Column:
    return F.coalesce(number(df, name), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def model_alerts(scored: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Nested alert of every event predicted serious.

    The alert id is made from the event id, so a replayed event gives the same alert.
    """
    hits = serious_gate(scored)
    p = F.col("confidence_serious")
    severity, drugs = _num(hits, "outcome_severity"), _num(hits, "drug_count")
    reactions, risk = _num(hits, "reaction_count"), _num(hits, "patient_risk_score")
    event_id = _text(hits, "event_id")
    return hits.select(
        F.concat(F.lit("ALERT_"), event_id).alias("alert_id"),
        F.date_format(F.current_timestamp() if stamp is None else stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        event_id.alias("event_id"),
        _text(hits, "safetyreportid").alias("safetyreportid"),
        F.struct(
            severity.alias("outcome_severity"),
            drugs.cast("int").alias("drug_count"),
            reactions.cast("int").alias("reaction_count"),
            risk.alias("patient_risk_score"),
            _text(hits, "source").alias("source"),
        ).alias("original_event"),
        F.struct(
            F.lit(1).alias("predicted_serious"),
            p.alias("confidence_serious"),
            alerts.is_confident(p).alias("high_confidence"),
            F.lit(K.SCORE_MODEL_VERSION).alias("model_version"),
        ).alias("ml_prediction"),
        alerts.score_level(p).alias("alert_level"),
        alerts.needs_review(p).alias("requires_review"),
        alerts.score_message(p, severity, drugs, risk).alias("alert_message"),
    )


def dedupe(events: DataFrame, ts: str, watermark: str, key: str = "event_id", salts: int = 1) -> DataFrame:
    """First arrival per key; the watermark bounds how long keys are remembered.

    With ``salts`` above 1 repeats are first dropped per key and salt, the salt being the input partition, so
    that a key repeated in much of the stream is spread over that many tasks and only one row of each is left for
    the last step.
    """
    marked = events.withWatermark(ts, watermark)
    if salts > 1:
        salted = marked.withColumn("_salt", F.spark_partition_id() % salts)
        marked = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def windowed_minutes(events: DataFrame, ts: str, watermark: str, serious: str = "serious") -> DataFrame:
    """Per-minute summary that a stream can emit in append mode."""
    return closed_minutes(events.withWatermark(ts, watermark), ts, serious)


def closed_minutes(events: DataFrame, ts: str, serious: str = "serious") -> DataFrame:
    """Per-minute summary of events that carry a watermark already, as ``dedupe`` leaves them. In append mode each minute
    comes once, when the watermark has passed it; later events of it are dropped."""
    return (
        events
        .groupBy(F.window(ts, "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col(serious) == 1).alias("serious_events"))
        .select(
            F.col("w.start").alias("minute"), "events", "serious_events",
            F.round(F.col("serious_events") * 100.0 / F.col("events"), 6).alias("serious_percent"),
        )
    )


def with_stats(scored: DataFrame, name: str = "stream_stats") -> DataFrame:
    """Count processed events and serious predictions as the stream runs."""
    return scored.observe(
        name,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("prediction") == 1).alias("serious_predicted"),
    )
