"""The test tables, and the domain inputs derived from them.

Each derived input is portable SQL, so that the same text feeds Spark and the checking engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Declared, so that reading a table starts no job to look at its footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

REPORTS = """
WITH li AS (
  SELECT l_orderkey, COUNT(*) AS drug_n, COUNT(DISTINCT p_type) AS reac_n,
         MIN(p_name) AS drug1, MIN(p_type) AS reac1,
         MIN(l_shipdate) AS ship1, CAST(SUM(l_quantity) AS BIGINT) AS qty
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT CAST(o_orderkey AS VARCHAR(20)) AS safetyreportid,
  CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS VARCHAR(8)) AS receivedate,
  CASE WHEN ship1 IS NULL THEN NULL WHEN o_orderkey % 41 = 0 THEN '20240230'
       ELSE CAST(year(ship1)*10000+month(ship1)*100+day(ship1) AS VARCHAR(8)) END AS receiptdate,
  CAST(year(o_orderdate)*10000+1231 AS VARCHAR(8)) AS transmissiondate,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '1.0'
       WHEN o_orderstatus = 'F' THEN '1' ELSE '2' END AS serious,
  CASE WHEN o_orderkey % 17 = 0 THEN '1' END AS seriousnessdeath,
  CASE WHEN o_orderkey % 13 = 0 THEN '1' ELSE '2' END AS seriousnesslifethreatening,
  CASE WHEN o_orderkey % 5 = 0 THEN '1' END AS seriousnesshospitalization,
  CASE WHEN o_orderkey % 11 = 0 THEN '1' END AS seriousnessdisabling,
  CASE WHEN o_orderkey % 29 = 0 THEN '1' END AS seriousnesscongenitalanomali,
  CASE WHEN o_orderkey % 53 = 0 THEN 'abc' WHEN o_orderkey % 59 = 0 THEN NULL
       ELSE CAST((o_custkey * 7 + o_orderkey) % 111 AS VARCHAR(10)) END AS patientonsetage,
  CASE WHEN qty IS NULL THEN NULL ELSE CAST(qty % 130 AS VARCHAR(10)) END AS patientweight,
  CAST(COALESCE(drug_n,0) AS INT) AS drug_count,
  CAST(COALESCE(reac_n,0) AS INT) AS reaction_count,
  CAST(o_custkey % 10 AS INT) AS outcome_severity,
  drug1 AS medicinalproduct, reac1 AS reactionmeddrapt,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE n_name END AS occurcountry,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE n_name END AS primarysourcecountry
FROM {orders} LEFT JOIN li ON o_orderkey = l_orderkey
  LEFT JOIN {customer} ON o_custkey = c_custkey
  LEFT JOIN {nation} ON c_nationkey = n_nationkey
"""

# The same rows with the sorted distinct lists of drugs and reactions, in Spark's words.
REPORTS_LISTED = REPORTS.replace("MIN(p_name) AS drug1,", """MIN(p_name) AS drug1,
         array_sort(collect_set(p_name)) AS drugs, array_sort(collect_set(p_type)) AS reactions,""").replace(
    "drug1 AS medicinalproduct,", "drug1 AS medicinalproduct, drugs, reactions,")

STUDIES = """
SELECT concat('NCT', lpad(CAST(p_partkey AS VARCHAR(8)), 8, '0')) AS nctId, p_name AS briefTitle,
  CASE p_size % 7 WHEN 0 THEN 'PHASE1' WHEN 1 THEN 'PHASE2' WHEN 2 THEN 'PHASE3' WHEN 3 THEN 'PHASE4'
       WHEN 4 THEN 'EARLY_PHASE1' WHEN 5 THEN 'PHASE1, PHASE2' END AS phase,
  CASE p_partkey % 3 WHEN 0 THEN 'INTERVENTIONAL' WHEN 1 THEN 'OBSERVATIONAL' END AS studyType,
  CASE p_partkey % 8 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'RECRUITING' WHEN 2 THEN 'NOT_YET_RECRUITING'
       WHEN 3 THEN 'ACTIVE_NOT_RECRUITING' WHEN 4 THEN 'TERMINATED' WHEN 5 THEN 'WITHDRAWN'
       WHEN 6 THEN 'SUSPENDED' END AS overallStatus,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat(CAST(1985 + p_partkey % 50 AS VARCHAR(4)), '-05')
       WHEN 2 THEN concat(CAST(1985 + p_partkey % 50 AS VARCHAR(4)), '-03-12') END AS startDate,
  CASE WHEN p_partkey % 5 = 0 THEN NULL
       ELSE concat('June ', CAST(1988 + p_partkey % 50 AS VARCHAR(4))) END AS completionDate,
  CASE WHEN p_partkey % 10 = 0 THEN 'n/a' ELSE CAST(p_size * 10 AS VARCHAR(8)) END AS enrollment,
  concat(p_brand, '|', p_type, '|', p_name, '|extra') AS interventions_text,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE concat(p_type, '|', p_brand, '|', p_name, '|other') END AS conditions_text
FROM {part}
"""

EVENT_STORE = """
SELECT CAST(event_id AS VARCHAR(20)) AS event_id, CAST(user_id AS VARCHAR(20)) AS safetyreportid,
  CAST(year(ts)*10000+month(ts)*100+day(ts) AS VARCHAR(8)) AS receivedate,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS serious, ts AS created_at
FROM {events}
"""

ALERT_STORE = """
SELECT CAST(event_id AS VARCHAR(20)) AS alert_id,
  CAST(CASE WHEN event_id % 37 = 0 THEN event_id + 100000000 ELSE event_id END AS VARCHAR(20)) AS event_id,
  'RULE_BASED' AS alert_type,
  CASE WHEN value > 100 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level, ts AS created_at
FROM {events} WHERE event_type IN ('error', 'purchase')
"""

SCORED_EVENTS = """
SELECT CAST(event_id AS VARCHAR(20)) AS event_id, ts,
  CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence_serious,
  CASE WHEN event_id % 101 > 50 THEN 1 ELSE 0 END AS prediction,
  CAST(event_id % 5 AS INT) AS outcome_severity, CAST(user_id % 5 AS INT) AS drug_count,
  CAST(event_id % 4 AS DOUBLE) * CAST(0.75 AS DOUBLE) AS patient_risk_score
FROM {events}
"""

# Stream messages: features as text, some unreadable, some missing; every 50th value is no JSON.
EVENT_FIELDS = """
SELECT event_id AS n, ts, CAST(event_id AS VARCHAR(20)) AS event_id,
  CAST(user_id AS VARCHAR(20)) AS safetyreportid,
  CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS is_serious, event_type AS source,
  CAST(event_id % 60 AS VARCHAR(10)) AS reporting_lag_days,
  CAST(1 + event_id % 12 AS VARCHAR(10)) AS report_month,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE '2024' END AS report_year,
  CAST(user_id % 4 AS VARCHAR(10)) AS weight_group, CAST(event_id % 4 AS VARCHAR(10)) AS age_group,
  CASE WHEN event_id % 11 = 0 THEN 'abc' ELSE CAST(user_id % 6 AS VARCHAR(10)) END AS drug_count,
  CASE WHEN event_id % 13 = 0 THEN 'NaN' ELSE CAST(event_id % 5 AS VARCHAR(10)) END AS reaction_count,
  CAST(event_id % 6 AS VARCHAR(10)) AS outcome_severity,
  CASE WHEN event_id % 3 = 0 THEN '0.5' WHEN event_id % 3 = 1 THEN '1.5' ELSE '1.75' END AS patient_risk_score,
  CASE WHEN event_id % 2 = 0 THEN '0.5' ELSE '2.0' END AS drug_risk_score,
  CAST(event_id % 6 AS VARCHAR(10)) AS occurcountry_encoded,
  CAST(user_id % 6 AS VARCHAR(10)) AS primarysourcecountry_encoded,
  CAST(event_id % 10 AS VARCHAR(10)) AS primary_drug_encoded,
  CAST(event_id % 15 AS VARCHAR(10)) AS primary_reaction_encoded
FROM {events}
"""

# Events as the rule alerter receives them: typed flags and numbers, some of them absent.
RULE_EVENTS = """
SELECT CAST(event_id AS VARCHAR(20)) AS event_id, ts,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR(20)) END AS safetyreportid,
  CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS seriousnessdeath,
  CASE WHEN event_id % 13 = 0 THEN 1 WHEN event_id % 13 = 1 THEN NULL ELSE 0 END AS seriousnesslifethreatening,
  CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS seriousnesshospitalization,
  CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS seriousnessdisabling,
  CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS seriousnesscongenitalanomali,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST((event_id * 7 + user_id) % 100 AS DOUBLE) END AS patient_age,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(user_id % 8 AS INT) END AS drug_count,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 6 AS INT) END AS reaction_count,
  CAST(event_id % 10 AS INT) AS outcome_severity
FROM {events}
"""

BRANDED = """
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'Advil' WHEN 1 THEN 'TYLENOL' WHEN 2 THEN 'motrin'
  WHEN 3 THEN 'Aleve' WHEN 4 THEN 'Aspirin' WHEN 5 THEN p_name END AS drug_name
FROM {part}
"""

OUTCOMES = """
SELECT o_orderkey AS primaryid, CASE o_orderkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN 'LT' WHEN 2 THEN 'HO'
  WHEN 3 THEN 'DS' WHEN 4 THEN 'CA' WHEN 5 THEN 'RI' WHEN 6 THEN 'OT' END AS outc_cod
FROM {orders}
"""

INPUTS = {
    "reports": REPORTS,
    "studies": STUDIES,
    "event_store": EVENT_STORE,
    "alert_store": ALERT_STORE,
    "scored_events": SCORED_EVENTS,
    "event_fields": EVENT_FIELDS,
    "rule_events": RULE_EVENTS,
    "branded": BRANDED,
    "outcomes": OUTCOMES,
}


def input_sql(name: str) -> str:
    """An input's text with plain table names."""
    return INPUTS[name].format(**{t: t for t in TABLE_NAMES})


class Tables:
    """The tables of one scale-factor folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _input(self, name: str) -> DataFrame:
        return self._bound(INPUTS[name])

    def _bound(self, text: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLE_NAMES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def reports(self) -> DataFrame:
        return self._input("reports")

    @cached_property
    def studies(self) -> DataFrame:
        return self._input("studies").drop("interventions_text", "conditions_text")

    @cached_property
    def event_store(self) -> DataFrame:
        return self._input("event_store")

    @cached_property
    def alert_store(self) -> DataFrame:
        return self._input("alert_store")

    @cached_property
    def scored_events(self) -> DataFrame:
        return self._input("scored_events")

    @cached_property
    def event_fields(self) -> DataFrame:
        return self._input("event_fields")

    @cached_property
    def rule_events(self) -> DataFrame:
        return self._input("rule_events")

    @cached_property
    def branded(self) -> DataFrame:
        return self._input("branded")

    @cached_property
    def outcomes(self) -> DataFrame:
        return self._input("outcomes")

    @cached_property
    def rule_reports(self) -> DataFrame:
        """Reports with the names the rules read."""
        return self.reports.withColumnRenamed("patientonsetage", "patient_age").withColumn(
            "event_id", F.col("safetyreportid"))

    @cached_property
    def reports_nested(self) -> DataFrame:
        """Reports in their nested landing form, with all their drugs and reactions."""
        raw = self._bound(REPORTS_LISTED)

        def structs(field: str, names: str):
            values = F.coalesce(F.col(names), F.array().cast("array<string>"))
            return F.transform(values, lambda v: F.struct(v.alias(field)))

        flat = [
            "safetyreportid", "serious", "seriousnessdeath", "seriousnesshospitalization",
            "seriousnesslifethreatening", "seriousnessdisabling", "seriousnesscongenitalanomali",
            "receivedate", "receiptdate", "transmissiondate", "primarysourcecountry", "occurcountry",
        ]
        duplicate = F.struct(
            F.col("primarysourcecountry").alias("duplicatesource"), F.col("safetyreportid").alias("duplicatenumb")
        )
        return raw.select(
            *flat,
            F.struct(
                F.col("serious").alias("qualification"), F.col("primarysourcecountry").alias("reportercountry")
            ).alias("primarysource"),
            F.when(F.col("outcome_severity") > 4, F.array(duplicate)).alias("reportduplicate"),
            F.struct(
                "patientonsetage",
                "patientweight",
                structs("medicinalproduct", "drugs").alias("drug"),
                structs("reactionmeddrapt", "reactions").alias("reaction"),
            ).alias("patient"),
        )

    @cached_property
    def studies_nested(self) -> DataFrame:
        s = self._input("studies")
        bar = "[|]"
        interventions = F.transform(F.split("interventions_text", bar), lambda v: F.struct(v.alias("name")))
        return s.select(F.struct(
            F.struct("nctId", "briefTitle").alias("identificationModule"),
            F.struct(
                F.split("phase", ", ").alias("phases"), "studyType",
                F.struct(F.col("enrollment").try_cast("bigint").alias("count")).alias("enrollmentInfo"),
            ).alias("designModule"),
            F.struct(
                "overallStatus",
                F.struct(F.col("startDate").alias("date")).alias("startDateStruct"),
                F.struct(F.col("completionDate").alias("date")).alias("primaryCompletionDateStruct"),
            ).alias("statusModule"),
            F.struct(interventions.alias("interventions")).alias("armsInterventionsModule"),
            F.struct(F.split("conditions_text", bar).alias("conditions")).alias("conditionsModule"),
        ).alias("protocolSection"))
