"""Profiles, rules, store and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alerts as alert_functions
from ..functions import dates
from ..functions.coerce import is_serious_text
from ..operators import ml, profile, rules, store
from ..operators.cleaning import clean_reports
from ..schemas import STORE_TABLES
from ..session import scratch_dir
from ..streaming import events as stream_events
from . import oracle as O
from .registry import query
from .report_queries import ID, _features_v1, training_features, stored_training
from .tables import Tables

RAW_COLUMNS = [
    "safetyreportid", "receivedate", "receiptdate", "transmissiondate", "serious", "seriousnessdeath",
    "seriousnesslifethreatening", "seriousnesshospitalization", "seriousnessdisabling",
    "seriousnesscongenitalanomali", "patientonsetage", "patientweight", "drug_count", "reaction_count",
    "outcome_severity", "medicinalproduct", "reactionmeddrapt", "occurcountry", "primarysourcecountry",
]
_HUNDRED = "CAST(100 AS DOUBLE)"
_MISSING_SQL = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLUMNS)
_CELLS_SQL = f"(COUNT(*) * {len(RAW_COLUMNS)})"
_FILLED_SQL = f"({_CELLS_SQL} - ({_MISSING_SQL})) * {_HUNDRED} / {_CELLS_SQL}"


# Profiles

@query("target_counts", O.using("reports", body=f"""
SELECT serious AS value, COUNT(*) AS n, round(COUNT(*) * {_HUNDRED} / (SELECT COUNT(*) FROM reports), 6) AS percent
FROM reports GROUP BY serious"""))
def target_counts(t: Tables) -> DataFrame:
    return profile.target_counts(t.reports, "serious")


@query("target_analysis", O.using("training", body=f"""
SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE is_serious = 1) AS serious_events,
  COUNT(*) FILTER (WHERE is_serious = 0) AS non_serious_events,
  round_even(COUNT(*) FILTER (WHERE is_serious = 1) * {_HUNDRED} / COUNT(*), 1) AS serious_rate_percent,
  CASE WHEN abs(COUNT(*) FILTER (WHERE is_serious = 1) - COUNT(*) FILTER (WHERE is_serious = 0)) <= 1
       THEN 'balanced' ELSE 'imbalanced' END AS class_balance
FROM training"""))
def target_analysis(t: Tables) -> DataFrame:
    return profile.target_analysis(training_features(t))


@query("risk_profile", O.using("features_v1", body=" UNION ALL ".join(f"""
SELECT '{c}' AS feature, round_even(avg({c}), 3) AS mean, round_even(stddev_samp({c}), 3) AS std,
  CAST(round_even(CAST(min({c}) AS DOUBLE), 3) AS DOUBLE) AS min, CAST(round_even(CAST(max({c}) AS DOUBLE), 3) AS DOUBLE) AS max,
  COUNT(*) FILTER (WHERE {c} > 0) AS non_zero_count FROM features_v1""" for c in profile.RISK_FEATURES)))
def risk_profile(t: Tables) -> DataFrame:
    return profile.risk_profile(_features_v1(t))


@query("lag_profile", O.using("clean", body="""
SELECT round_even(avg(reporting_lag_days), 1) AS mean_days,
  round_even(CAST(max(reporting_lag_days) AS DOUBLE), 1) AS max_days,
  COUNT(*) FILTER (WHERE reporting_lag_days <= 1) AS quick_reports,
  COUNT(*) FILTER (WHERE reporting_lag_days > 7) AS delayed_reports FROM clean"""))
def lag_profile(t: Tables) -> DataFrame:
    return profile.lag_profile(clean_reports(t.reports))


@query("eda_date_range", O.using("reports", body=f"""
SELECT strftime(min({O.day('receiptdate')}), '%Y-%m-%d') AS earliest_date,
  strftime(max({O.day('receiptdate')}), '%Y-%m-%d') AS latest_date,
  CAST(date_diff('day', min({O.day('receiptdate')}), max({O.day('receiptdate')})) AS INTEGER) AS date_span_days
FROM reports"""))
def eda_date_range(t: Tables) -> DataFrame:
    return profile.date_range(t.reports, dates.report_day("receiptdate"))


@query("data_quality_score", O.using("reports", body=
       f"SELECT round_even({_FILLED_SQL}, 1) AS data_quality_score FROM reports"))
def data_quality_score(t: Tables) -> DataFrame:
    return profile.data_quality_score(t.reports)


@query("missing_by_column", O.using("reports", body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM reports" for c in RAW_COLUMNS)))
def missing_by_column(t: Tables) -> DataFrame:
    return profile.missing_by_column(t.reports)


@query("missing_total", O.using("reports", body=f"SELECT {_MISSING_SQL} AS missing FROM reports"))
def missing_total(t: Tables) -> DataFrame:
    return profile.missing_total(t.reports)


@query("data_overview", O.using("reports", body=f"""
SELECT COUNT(*) AS total_records, CAST({len(RAW_COLUMNS)} AS BIGINT) AS total_features,
  round_even({_FILLED_SQL}, 1) AS data_quality_score, CAST(3 AS BIGINT) AS numeric_features,
  CAST({len(RAW_COLUMNS) - 3} AS BIGINT) AS categorical_features FROM reports"""))
def data_overview(t: Tables) -> DataFrame:
    return profile.data_overview(t.reports)


@query("ml_readiness", O.using("training", body="""
SELECT n AS records, CAST(19 AS BIGINT) AS features, CAST(16 AS BIGINT) AS numeric_features, s AS serious_events,
  o AS non_serious_events, m AS missing, round(CAST(100 AS DOUBLE) * (n * 19 - m) / (n * 19), 6) AS completeness,
  round(CAST(LEAST(s, o) AS DOUBLE) / GREATEST(s, o), 6) AS balance_ratio,
  CASE WHEN (n * 19 - m) * CAST(100 AS DOUBLE) / (n * 19) > 95 AND n > 10000 THEN 100 ELSE 85 END AS ml_ready_score,
  (n * 19 - m) * CAST(100 AS DOUBLE) / (n * 19) > 95 AND n > 10000 AS ml_ready
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_serious = 1) AS s, COUNT(*) FILTER (WHERE is_serious = 0) AS o,
  COUNT(*) FILTER (WHERE receivedate IS NULL) + COUNT(*) FILTER (WHERE transmissiondate IS NULL) AS m FROM training) x"""))
def ml_readiness(t: Tables) -> DataFrame:
    return profile.ml_readiness(training_features(t))


@query("size_verdict", "SELECT COUNT(*) AS records, CASE WHEN COUNT(*) < 100 THEN 'too small' ELSE 'adequate' END AS verdict FROM orders")
def size_verdict(t: Tables) -> DataFrame:
    return profile.size_verdict(t.reports)


_INSIGHTS_SQL = """SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS insight_no, insight FROM (
  SELECT 1 AS k, CASE WHEN n < 10 THEN printf('Small sample size (%d records) - suitable for proof-of-concept development', n)
    WHEN n < 100 THEN printf('Medium sample size (%d records) - good for initial model training', n)
    ELSE printf('Large sample size (%d records) - excellent for robust model training', n) END AS insight FROM s
  UNION ALL SELECT 2, CASE WHEN rate = 0 THEN 'Current sample contains only non-serious events - need diverse data for balanced ML training'
    WHEN rate < 10 THEN printf('Low serious event rate (%.1f%%) - typical for post-market surveillance data', rate)
    WHEN rate > 50 THEN printf('High serious event rate (%.1f%%) - may indicate focus on high-risk drugs/populations', rate) END FROM s
  UNION ALL SELECT 3, 'Perfect data quality - no missing values detected after cleaning' FROM s
  UNION ALL SELECT 4, CASE WHEN worst = 0 THEN 'Current sample shows low-severity outcomes - suitable for safety baseline establishment'
    ELSE printf('Severity scores range 0-%d - good for outcome prediction modeling', worst) END FROM s
  UNION ALL SELECT 5, 'Rich feature set (28 features) - excellent foundation for ML model performance' FROM s
  UNION ALL SELECT 6, 'Pipeline successfully processes FDA data - ready to scale to larger datasets' FROM s
  UNION ALL SELECT 7, 'Recommend collecting 1000+ records for production-ready ML model training' FROM s
) f WHERE insight IS NOT NULL"""
_INSIGHT_STATS_SQL = """
SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_serious = 1) AS serious, COUNT(*) FILTER (WHERE is_serious = 0) AS other,
  COUNT(*) FILTER (WHERE is_serious = 1) * CAST(100 AS DOUBLE) / COUNT(*) AS rate,
  max(outcome_severity) AS worst FROM features_v1"""


@query("insights", O.using("features_v1", body=_INSIGHTS_SQL, extra={"s": _INSIGHT_STATS_SQL}))
def insights(t: Tables) -> DataFrame:
    return profile.insights(_features_v1(t))


def _report_sql() -> str:
    rule, thin = "'" + "=" * 80 + "'", "'" + "-" * 40 + "'"
    head = [rule, "'CLINICAL TRIAL SAFETY MONITORING - EDA REPORT'", rule, "''", "'DATA OVERVIEW'", thin,
            "concat('Total Records: ', n)", "'Total Features: 28'", "'Data Quality Score: 100.0/100'",
            "''", "'TARGET VARIABLE ANALYSIS'", thin, "concat('Total Events: ', n)", "concat('Serious Events: ', serious)",
            "concat('Non-Serious Events: ', other)", "concat('Serious Event Rate: ', CAST(round_even(rate, 1) AS VARCHAR), '%')",
            "CASE WHEN abs(serious - other) <= 1 THEN 'Class Balance: Balanced' ELSE 'Class Balance: Imbalanced' END",
            "''", "'RISK FACTOR ANALYSIS'", thin]
    risks = []
    for c in profile.RISK_FEATURES:
        title = c.replace("_", " ").title()
        number = f"CAST(round_even(CAST({{}}({c}) AS DOUBLE), 3) AS VARCHAR)"
        risks += [f"'{title}:'", "concat('  Mean: ', " + number.format("avg") + ")",
                  "concat('  Range: ', " + number.format("min") + ", ' - ', " + number.format("max") + ")",
                  f"concat('  Non-zero: ', COUNT(*) FILTER (WHERE {c} > 0), ' records')"]
    middle = ["''", "'BUSINESS INSIGHTS'", thin]
    foot = ["''", rule, "'READY FOR MACHINE LEARNING MODEL DEVELOPMENT'", rule]
    rows = [f"SELECT {i} AS k, {e} AS line FROM s" for i, e in enumerate(head)]
    rows += [f"SELECT {100 + i}, {e} FROM {'features_v1' if '(' in e else 's'}" for i, e in enumerate(risks)]
    rows += [f"SELECT {200 + i}, {e} FROM s" for i, e in enumerate(middle)]
    rows += ["SELECT 300 + insight_no, concat(insight_no, '. ', insight) FROM ins"]
    rows += [f"SELECT {400 + i}, {e} FROM s" for i, e in enumerate(foot)]
    return O.using(
        "features_v1",
        body="SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS line_no, line FROM ("
             + " UNION ALL ".join(rows) + ") r",
        extra={"s": _INSIGHT_STATS_SQL, "ins": _INSIGHTS_SQL},
    )


@query("eda_report_lines", _report_sql())
def eda_report_lines(t: Tables) -> DataFrame:
    return profile.report_lines(_features_v1(t))


@query("eda_report_file", _report_sql())
def eda_report_file(t: Tables) -> DataFrame:
    """The report written as one text file and read back, its lines numbered as they stand in the file."""
    path = scratch_dir(t.spark, "report")
    profile.write_report(profile.report_lines(_features_v1(t)), path)
    lines = F.split(F.col("value"), "\n")
    whole = t.spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.slice(lines, F.lit(1), F.size(lines) - 1)).alias("at", "line")).select(
        (F.col("at") + 1).alias("line_no"), "line")


_SPLIT_SIZES = """SELECT is_serious, n, round(n * 0.10) AS test, round((n - round(n * 0.10)) * 0.22) AS validation
FROM (SELECT is_serious, CAST(COUNT(*) AS DOUBLE) AS n FROM training GROUP BY is_serious) c"""
_SPLIT_COUNTS = """SELECT split, is_serious AS label,
  CAST(CASE split WHEN 'test' THEN test WHEN 'validation' THEN validation ELSE n - test - validation END AS BIGINT) AS n
FROM sizes, (VALUES ('test'), ('validation'), ('train')) parts(split)"""


@query("split_balance", O.using("training", extra={"sizes": _SPLIT_SIZES, "counts": _SPLIT_COUNTS}, body="""
SELECT split, label, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY split), 6) AS fraction FROM counts"""))
def split_balance(t: Tables) -> DataFrame:
    return profile.split_balance(ml.with_split(stored_training(t)))


@query("stratified_split", O.using("training", body="SELECT safetyreportid, is_serious, 1 AS parts FROM training"))
def stratified_split(t: Tables) -> DataFrame:
    """Every report with the number of parts it lies in."""
    parts = ml.with_split(stored_training(t)).groupBy(ID, "is_serious").agg(
        F.count_if(F.col("split").isin("train", "validation", "test")).cast("int").alias("parts"))
    return parts


_MINUTE_SQL = """SELECT date_trunc('minute', created_at) AS minute, COUNT(*) AS events,
  COUNT(*) FILTER (WHERE serious = 1) AS serious_events,
  round(COUNT(*) FILTER (WHERE serious = 1) * CAST(100 AS DOUBLE) / COUNT(*), 6) AS serious_percent
  FROM event_store GROUP BY 1"""


def _minutes_ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("minute_summary", O.using("event_store", body=_MINUTE_SQL))
def minute_summary(t: Tables) -> DataFrame:
    return _minutes_ntz(profile.minute_summary(t.event_store, "created_at"))


@query("running_minute_summary", O.using("event_store", body=f"""
SELECT minute, events, serious_events, CAST(sum(events) OVER w AS BIGINT) AS total_events,
  CAST(sum(serious_events) OVER w AS BIGINT) AS total_serious,
  round(CAST(sum(serious_events) OVER w AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(sum(events) OVER w AS DOUBLE), 6) AS total_serious_percent
FROM ({_MINUTE_SQL}) m WINDOW w AS (ORDER BY minute)"""))
def running_minute_summary(t: Tables) -> DataFrame:
    return _minutes_ntz(profile.running_minute_summary(profile.minute_summary(t.event_store, "created_at")))


# Rules

@query("rule_risk_score", O.using("ruled", body="SELECT event_id, risk_score FROM ruled"))
def rule_risk_score(t: Tables) -> DataFrame:
    return rules.assess(t.rule_reports).select("event_id", "risk_score")


@query("rule_risk_factors", O.using("ruled", body="SELECT event_id, risk_factors FROM ruled"))
def rule_risk_factors(t: Tables) -> DataFrame:
    return rules.assess(t.rule_reports).select("event_id", F.array_join("risk_factors", ", ").alias("risk_factors"))


@query("rule_alert_level", O.using("ruled", body=f"""
SELECT event_id, {O.LEVEL} AS alert_level, {O.yes('risk_score >= CAST(0.5 AS DOUBLE)')} AS prediction FROM ruled"""))
def rule_alert_level(t: Tables) -> DataFrame:
    return rules.assess(t.rule_reports).select("event_id", "alert_level", "prediction")


@query("rule_level_counts", O.using("ruled", body=f"""
SELECT {O.LEVEL} AS alert_level, COUNT(*) AS reports FROM ruled GROUP BY 1"""))
def rule_level_counts(t: Tables) -> DataFrame:
    return rules.assess(t.rule_reports).groupBy("alert_level").agg(F.count(F.lit(1)).alias("reports"))


@query("alert_gate_rule", O.using("ruled", body=
       "SELECT event_id, risk_score FROM ruled WHERE risk_score >= CAST(0.5 AS DOUBLE)"))
def alert_gate_rule(t: Tables) -> DataFrame:
    return rules.rule_alert_gate(rules.assess(t.rule_reports)).select("event_id", "risk_score")


@query("rule_defaults", O.using("ruled_events", body=
       f"SELECT event_id, risk_score, risk_factors, {O.LEVEL} AS alert_level FROM ruled_events"))
def rule_defaults(t: Tables) -> DataFrame:
    return rules.assess(t.rule_events).select(
        "event_id", "risk_score", F.array_join("risk_factors", ", ").alias("risk_factors"), "alert_level")


_EVENT_ROW_SQL = f"""SELECT event_id, safetyreportid, {O.yes('risk_score >= CAST(0.5 AS DOUBLE)')} AS serious,
  CAST(trunc(risk_score * 10) AS INTEGER) AS outcome_severity, risk_score AS patient_risk_score"""
_EVENT_ROW = ["event_id", "safetyreportid", "serious", "outcome_severity", "patient_risk_score"]
_ALERT_ROW_SQL = f"""SELECT event_id, 'RULE_BASED' AS alert_type, {O.LEVEL} AS alert_level,
  risk_score AS prediction_probability, 'rule_based_v1.0' AS model_version,
  concat('Rule-based alert: ', {O.LEVEL}, ' risk - ', risk_factors) AS alert_message"""
_ALERT_ROW = ["event_id", "alert_type", "alert_level", "prediction_probability", "model_version", "alert_message"]


@query("rule_event_rows", O.using("ruled_events", body=_EVENT_ROW_SQL + " FROM ruled_events"))
def rule_event_rows(t: Tables) -> DataFrame:
    return rules.rule_event_rows(rules.assessed_with_source(t.rule_events)).select(*_EVENT_ROW)


@query("rule_alerts", O.using("ruled_events", body=
       _ALERT_ROW_SQL + " FROM ruled_events WHERE risk_score >= CAST(0.5 AS DOUBLE)"))
def rule_alerts(t: Tables) -> DataFrame:
    return rules.rule_alerts(rules.assessed_with_source(t.rule_events)).select(*_ALERT_ROW)


# Model alerts on given probabilities

@query("alert_levels", O.using("scored_events", body=f"""
SELECT event_id, CASE WHEN confidence_serious > CAST(0.9 AS DOUBLE) THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level,
  {O.yes('confidence_serious > CAST(0.8 AS DOUBLE)')} AS requires_review,
  {O.yes('GREATEST(confidence_serious, CAST(1 AS DOUBLE) - confidence_serious) > CAST(0.8 AS DOUBLE)')} AS high_confidence
FROM scored_events"""))
def alert_levels(t: Tables) -> DataFrame:
    p = F.col("confidence_serious")
    return t.scored_events.select(
        "event_id", alert_functions.score_level(p).alias("alert_level"),
        alert_functions.needs_review(p).alias("requires_review"),
        alert_functions.is_confident(p).alias("high_confidence"))


_MESSAGE_SQL = """concat(printf('SERIOUS ADVERSE EVENT DETECTED (Confidence: %.1f%%)', confidence_serious * 100),
  CASE WHEN outcome_severity >= 3 THEN ' - High outcome severity' ELSE '' END,
  CASE WHEN drug_count > 2 THEN ' - Multiple drugs involved' ELSE '' END,
  CASE WHEN patient_risk_score > CAST(1.5 AS DOUBLE) THEN ' - High-risk patient' ELSE '' END)"""


@query("alert_message", O.using("scored_events", body=f"SELECT event_id, {_MESSAGE_SQL} AS alert_message FROM scored_events"))
def alert_message(t: Tables) -> DataFrame:
    message = alert_functions.score_message(
        F.col("confidence_serious"), F.col("outcome_severity"), F.col("drug_count"), F.col("patient_risk_score"))
    return t.scored_events.select("event_id", message.alias("alert_message"))


@query("alert_gate_model", O.using("scored_events", body=f"""
SELECT concat('ALERT_', event_id) AS alert_id, event_id, {_MESSAGE_SQL} AS alert_message
FROM scored_events WHERE prediction = 1"""))
def alert_gate_model(t: Tables) -> DataFrame:
    return stream_events.model_alerts(t.scored_events).select("alert_id", "event_id", "alert_message")


@query("classification_metrics", O.using("ruled", body="""
SELECT n AS rows, round(CAST(hit AS DOUBLE) / n, 6) AS accuracy, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
  round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall, round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1_score
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_serious = p) AS hit,
  COUNT(*) FILTER (WHERE is_serious = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE is_serious = 0 AND p = 1) AS fp,
  COUNT(*) FILTER (WHERE is_serious = 1 AND p = 0) AS fn
  FROM (SELECT is_serious, CASE WHEN risk_score >= CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS p FROM ruled) a) b"""))
def classification_metrics(t: Tables) -> DataFrame:
    labelled = rules.assess(t.rule_reports).withColumn("is_serious", is_serious_text("serious"))
    return ml.classification_metrics(labelled)


# Store

def _latest(df: DataFrame) -> Column:
    """Newest creation time of a table, the 'now' of the dashboard queries."""
    return df.agg(F.max("created_at")).scalar()


def _recent_sql(extra: str = "") -> str:
    return O.using("event_store", "alert_store", body=f"""
SELECT a.alert_id, a.event_id, a.alert_type, a.alert_level, a.created_at, e.safetyreportid, e.receivedate
FROM alert_store a JOIN event_store e ON a.event_id = e.event_id
WHERE a.created_at >= (SELECT max(created_at) FROM event_store) - INTERVAL '24' HOUR {extra}""")


@query("recent_alerts", _recent_sql())
def recent_alerts(t: Tables) -> DataFrame:
    return store.recent_alerts(t.alert_store, t.event_store, as_of=_latest(t.event_store), tie_break=["alert_id"])


@query("recent_alerts_high", _recent_sql("AND a.alert_level = 'HIGH'"))
def recent_alerts_high(t: Tables) -> DataFrame:
    return store.recent_alerts(
        t.alert_store, t.event_store, alert_level="HIGH", as_of=_latest(t.event_store), tie_break=["alert_id"])


_ALERT_COLUMNS = "alert_id, event_id, alert_type, alert_level, created_at"


@query("alerts_with_event", O.using("event_store", "alert_store", body=
       f"SELECT {_ALERT_COLUMNS} FROM alert_store WHERE event_id IN (SELECT event_id FROM event_store)"))
def alerts_with_event(t: Tables) -> DataFrame:
    return store.alerts_with_event(t.alert_store, t.event_store)


@query("orphan_alerts", O.using("event_store", "alert_store", body=
       f"SELECT {_ALERT_COLUMNS} FROM alert_store WHERE event_id NOT IN (SELECT event_id FROM event_store)"))
def orphan_alerts(t: Tables) -> DataFrame:
    return store.orphan_alerts(t.alert_store, t.event_store)


@query("system_stats", O.using("event_store", "alert_store", body="""
SELECT (SELECT COUNT(*) FROM event_store) AS total_events,
  (SELECT COUNT(*) FROM event_store WHERE serious = 1) AS serious_events,
  (SELECT COUNT(*) FROM alert_store) AS total_alerts,
  (SELECT COUNT(*) FROM alert_store WHERE alert_level = 'HIGH'
     AND created_at >= (SELECT max(created_at) FROM event_store) - INTERVAL '24' HOUR) AS high_alerts_24h,
  (SELECT COUNT(*) FROM event_store
     WHERE created_at >= (SELECT max(created_at) FROM event_store) - INTERVAL '24' HOUR) AS events_last_24h"""))
def system_stats(t: Tables) -> DataFrame:
    return store.system_stats(t.event_store, t.alert_store, as_of=_latest(t.event_store))


def _store_root(t: Tables, *names: str) -> str:
    root = scratch_dir(t.spark, "store")
    store.create_tables(t.spark, root, names or tuple(STORE_TABLES))
    return root


_STORED_EVENT_SQL = """SELECT event_id, safetyreportid, CAST(try_strptime(receivedate, '%Y%m%d') AS DATE) AS receivedate,
  serious, created_at"""
_STORED_EVENT = ["event_id", "safetyreportid", "receivedate", "serious"]


def _stored_events(t: Tables, root: str) -> DataFrame:
    rows = store.read_table(t.spark, root, "adverse_events")
    return rows.select(*_STORED_EVENT, F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query("store_events", O.using("event_store", body=_STORED_EVENT_SQL + " FROM event_store"))
def store_events(t: Tables) -> DataFrame:
    root = _store_root(t, "adverse_events")
    store.append_batch(store.conform(t.event_store, "adverse_events"), root, "adverse_events", 0)
    return _stored_events(t, root)


@query("store_alerts", O.using("alert_store", body="""
SELECT alert_id, event_id, alert_type, alert_level, FALSE AS is_reviewed, created_at FROM alert_store"""))
def store_alerts(t: Tables) -> DataFrame:
    root = _store_root(t, "safety_alerts")
    store.append_batch(store.conform(t.alert_store, "safety_alerts"), root, "safety_alerts", 0)
    rows = store.read_table(t.spark, root, "safety_alerts")
    return rows.select(
        "alert_id", "event_id", "alert_type", "alert_level", "is_reviewed",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query("bulk_insert_ignore", O.using("event_store", body=_STORED_EVENT_SQL + """ FROM event_store
WHERE CAST(event_id AS BIGINT) % 3 = 0 OR CAST(event_id AS BIGINT) % 2 = 0"""))
def bulk_insert_ignore(t: Tables) -> DataFrame:
    """The store holds every third event; a batch of every second event, each listed twice, is inserted."""
    name = "adverse_events"
    root = _store_root(t, name)
    number = F.col("event_id").cast("bigint")
    store.append_batch(store.conform(t.event_store.where(number % 3 == 0), name), root, name, 0)
    half = store.conform(t.event_store.where(number % 2 == 0), name)
    later = half.withColumns({"serious": F.lit(9), "created_at": F.col("created_at") + F.expr("INTERVAL 1 HOUR")})
    batch = half.unionByName(later)
    fresh = store.insert_ignore(batch, store.read_keys(t.spark, root, name, batch), "created_at")
    store.append_batch(fresh, root, name, 1)
    return _stored_events(t, root)


_FILLED = {
    "adverse_events": ("event_store", ["event_id", "safetyreportid", "receivedate", "serious", "created_at", "updated_at"]),
    "safety_alerts": ("alert_store", ["alert_id", "event_id", "alert_type", "alert_level", "is_reviewed", "created_at"]),
}


def _store_tables_sql() -> str:
    rows = []
    for name, schema in STORE_TABLES.items():
        source, filled = _FILLED.get(name, ("event_store", []))
        for i, field in enumerate(schema.fields):
            count = f"(SELECT COUNT(*) FROM {source})" if field.name in filled else "CAST(0 AS BIGINT)"
            rows.append(f"SELECT '{name}' AS table_name, {i} AS position, '{field.name}' AS column_name, "
                        f"'{field.dataType.simpleString()}' AS type, {count} AS filled")
    return O.using("event_store", "alert_store", body=" UNION ALL ".join(rows))


@query("create_store_tables", _store_tables_sql())
def create_store_tables(t: Tables) -> DataFrame:
    """One row per table and column, with how many of the stored rows fill it."""
    root = _store_root(t)
    store.append_batch(store.conform(t.event_store, "adverse_events"), root, "adverse_events", 0)
    store.append_batch(store.conform(t.alert_store, "safety_alerts"), root, "safety_alerts", 0)
    out = None
    for name, schema in STORE_TABLES.items():
        rows = store.read_table(t.spark, root, name)
        counts = rows.agg(*[F.count(f.name).alias(f.name) for f in schema.fields])
        entries = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("filled"))
            for i, f in enumerate(schema.fields)
        ])
        table = counts.select(F.lit(name).alias("table_name"), F.inline(entries))
        out = table if out is None else out.unionByName(table)
    return out
