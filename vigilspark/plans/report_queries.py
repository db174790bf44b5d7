"""Searches, flattening, cleaning, features and encodings of reports and trials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, dates, risk, trials
from ..functions.coerce import is_serious_numeric, is_serious_text, to_number
from ..functions.text import ascii_only
from ..operators import cleaning, columns, encoding, features, filters, nested
from ..session import compilable_code, scratch_dir
from . import oracle as O
from .registry import query
from .tables import Tables

TRAINING = features.TrainingColumns(
    weight="patientweight", age="patientonsetage", drug="medicinalproduct", reaction="reactionmeddrapt"
)

ID = "safetyreportid"
_SEARCH = [ID, "receivedate", "serious", "occurcountry"]
_SEARCH_SQL = ", ".join(_SEARCH)


def _reports(body: str) -> str:
    return O.using("reports", body=body)


# Searches

@query("filter_receive_window", _reports(
    f"SELECT {_SEARCH_SQL} FROM reports WHERE receivedate BETWEEN '19970301' AND '19990630'"))
def filter_receive_window(t: Tables) -> DataFrame:
    return filters.filter_receive_window(t.reports, "19970301", "19990630").select(*_SEARCH)


@query("filter_search_terms", _reports(
    f"SELECT {_SEARCH_SQL} FROM reports WHERE serious = '1' AND seriousnessdeath = '1'"))
def filter_search_terms(t: Tables) -> DataFrame:
    return filters.filter_search_terms(t.reports, ["serious:1", "seriousnessdeath:1"]).select(*_SEARCH)


@query("filter_serious", _reports(f"SELECT {_SEARCH_SQL} FROM reports WHERE serious = '2'"))
def filter_serious(t: Tables) -> DataFrame:
    return filters.filter_serious(t.reports, serious=False).select(*_SEARCH)


@query("limit_reports", _reports(f"SELECT {_SEARCH_SQL} FROM reports ORDER BY safetyreportid LIMIT 5000"))
def limit_reports(t: Tables) -> DataFrame:
    return filters.limit_reports(t.reports.select(*_SEARCH), 5000)


@query("fetch_with_fallback", _reports(
    f"""SELECT {_SEARCH_SQL} FROM reports WHERE receivedate BETWEEN '19970301' AND '19970630'
    OR NOT EXISTS (SELECT 1 FROM reports r WHERE r.receivedate BETWEEN '19970301' AND '19970630')"""))
def fetch_with_fallback(t: Tables) -> DataFrame:
    return filters.fetch_with_fallback(t.reports.select(*_SEARCH), "19970301", "19970630")


@query("fetch_with_fallback_all", _reports(
    f"""SELECT {_SEARCH_SQL} FROM reports WHERE receivedate BETWEEN '20240101' AND '20240331'
    OR NOT EXISTS (SELECT 1 FROM reports r WHERE r.receivedate BETWEEN '20240101' AND '20240331')"""))
def fetch_with_fallback_all(t: Tables) -> DataFrame:
    return filters.fetch_with_fallback(t.reports.select(*_SEARCH))


@query("fetch_reports", _reports(
    f"""SELECT {_SEARCH_SQL} FROM reports WHERE receivedate BETWEEN '19970301' AND '19990630' AND serious = '1'
    ORDER BY safetyreportid LIMIT 250"""))
def fetch_reports(t: Tables) -> DataFrame:
    return filters.fetch_reports(t.reports.select(*_SEARCH), "19970301", "19990630", 250, ["serious:1"])


def _class_block(serious: str, n: int | str) -> str:
    return f"""(SELECT {_SEARCH_SQL} FROM reports WHERE serious = '{serious}'
    ORDER BY CASE WHEN receivedate BETWEEN '19970301' AND '19970630' THEN 0 ELSE 1 END, receivedate, safetyreportid
    LIMIT {n})"""


@query("balanced_sample", _reports(_class_block("1", 500) + " UNION ALL " + _class_block("2", 500)))
def balanced_sample(t: Tables) -> DataFrame:
    return filters.balanced_sample(t.reports.select(*_SEARCH), 500, 500, "19970301", "19970630")


def _class_quarter(serious: str) -> str:
    return _class_block(serious, "(SELECT COUNT(*) // 4 FROM reports)")


@query("balanced_sample_half", _reports(_class_quarter("1") + " UNION ALL " + _class_quarter("2")))
def balanced_sample_half(t: Tables) -> DataFrame:
    """Half of all reports, a quarter of each class."""
    reports = t.reports.select(*_SEARCH)
    quarter = reports.count() // 4
    return filters.balanced_sample(reports, quarter, quarter, "19970301", "19970630")


_STUDY = "nctId, briefTitle, phase, studyType, overallStatus"


@query("studies_by_phase", O.using("study_records", body="""
SELECT nctId, briefTitle, 'PHASE2' AS phase, studyType, overallStatus, startDate, completionDate, enrollment
FROM study_records WHERE list_contains(phases, 'PHASE2')"""))
def studies_by_phase(t: Tables) -> DataFrame:
    return nested.studies_by_phase(t.studies_nested, "PHASE2")


@query("studies_by_drug", O.using("study_records", body=f"""
SELECT 'Gear' AS drug_searched, {_STUDY}, enrollment, interventions FROM study_records
WHERE lower(array_to_string(intervention_list, '|')) LIKE '%gear%' ORDER BY nctId LIMIT 2000"""))
def studies_by_drug(t: Tables) -> DataFrame:
    return nested.studies_by_drug(t.studies_nested, "Gear", 2000)


@query("recent_studies", O.using("study_records", body=f"""
SELECT {_STUDY}, startDate, completionDate, enrollment, conditions FROM study_records
WHERE raw_start >= '2020-01-01'"""))
def recent_studies(t: Tables) -> DataFrame:
    return nested.recent_studies(t.studies_nested, "2020-01-01")


@query("study_details", O.using("studies", body="""
SELECT nctId, briefTitle, overallStatus FROM studies WHERE nctId = 'NCT00000042'"""))
def study_details(t: Tables) -> DataFrame:
    details = nested.study_details(t.studies_nested, "NCT00000042")
    return details.select("identificationModule.*", "statusModule.overallStatus")


@query("sample_events", "SELECT CAST(0 AS BIGINT) AS strangers, TRUE AS near_half")
def sample_events(t: Tables) -> DataFrame:
    """A random draw of half as many events: all of them known, and about as many as asked for."""
    drawn = filters.sample_events(t.event_store, 0.5)
    strangers = drawn.join(t.event_store, "event_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    share = F.count(F.lit(1)) / t.event_store.agg(F.count(F.lit(1))).scalar()
    return drawn.agg(share.between(0.4, 0.6).alias("near_half")).select(strangers.alias("strangers"), "near_half")


# Flattening

def _names(array, field: str):
    return F.array_join(F.transform(array, lambda x: x[field]), ", ")


_DRUGS_SQL, _REACTIONS_SQL = (f"COALESCE(array_to_string({names}, ', '), '')" for names in ("drugs", "reactions"))


@query("json_normalize", O.using("reports_listed", body=f"""
SELECT safetyreportid, serious AS "primarysource.qualification",
  primarysourcecountry AS "primarysource.reportercountry", patientonsetage AS "patient.patientonsetage",
  patientweight AS "patient.patientweight", {_DRUGS_SQL} AS "patient.drug", {_REACTIONS_SQL} AS "patient.reaction"
FROM reports_listed"""))
def json_normalize(t: Tables) -> DataFrame:
    flat = nested.json_normalize(t.reports_nested)
    return flat.select(
        ID,
        *[columns.named(c) for c in ("primarysource.qualification", "primarysource.reportercountry",
                                     "patient.patientonsetage", "patient.patientweight")],
        _names(columns.named("patient.drug"), "medicinalproduct").alias("patient.drug"),
        _names(columns.named("patient.reaction"), "reactionmeddrapt").alias("patient.reaction"),
    )


@query("flatten_first", O.using("reports_listed", body=f"""
SELECT safetyreportid, serious AS primarysource_qualification,
  CASE WHEN outcome_severity > 4 THEN primarysourcecountry END AS reportduplicate_duplicatesource,
  CASE WHEN outcome_severity > 4 THEN safetyreportid END AS reportduplicate_duplicatenumb,
  patientonsetage AS patient_patientonsetage, patientweight AS patient_patientweight,
  {_DRUGS_SQL} AS patient_drug, {_REACTIONS_SQL} AS patient_reaction
FROM reports_listed"""))
def flatten_first(t: Tables) -> DataFrame:
    flat = nested.flatten_first(t.reports_nested)
    return flat.select(
        ID, "primarysource_qualification", "reportduplicate_duplicatesource", "reportduplicate_duplicatenumb",
        "patient_patientonsetage", "patient_patientweight",
        _names(F.col("patient_drug"), "medicinalproduct").alias("patient_drug"),
        _names(F.col("patient_reaction"), "reactionmeddrapt").alias("patient_reaction"),
    )


@query("study_records", O.using("study_records", body=f"""
SELECT {_STUDY}, startDate, completionDate, enrollment, interventions, conditions FROM study_records"""))
def study_records(t: Tables) -> DataFrame:
    return nested.study_records(t.studies_nested)


@query("study_phase_text", O.using("study_records", body="SELECT nctId, phase FROM study_records"))
def study_phase_text(t: Tables) -> DataFrame:
    return nested.study_records(t.studies_nested).select("nctId", "phase")


@query("study_top3", O.using("study_records", body="SELECT nctId, interventions, conditions FROM study_records"))
def study_top3(t: Tables) -> DataFrame:
    return nested.study_records(t.studies_nested).select("nctId", "interventions", "conditions")


# Scalars

@query("coerce_numeric", _reports(f"""
SELECT safetyreportid, {O.number('patientonsetage')} AS age, {O.number('patientweight')} AS weight,
  {O.number('serious')} AS serious_number FROM reports"""))
def coerce_numeric(t: Tables) -> DataFrame:
    return t.reports.select(
        ID, to_number("patientonsetage").alias("age"), to_number("patientweight").alias("weight"),
        to_number("serious").alias("serious_number"))


@query("is_serious_numeric", _reports(
    f"SELECT safetyreportid, {O.yes(O.number('serious') + ' = 1')} AS is_serious FROM reports"))
def is_serious_numeric_query(t: Tables) -> DataFrame:
    return t.reports.select(ID, is_serious_numeric("serious").alias("is_serious"))


@query("is_serious_string", _reports(
    f"""SELECT safetyreportid, {O.yes("serious = '1'")} AS is_serious FROM reports"""))
def is_serious_string(t: Tables) -> DataFrame:
    return t.reports.select(ID, is_serious_text("serious").alias("is_serious"))


@query("clean_dates", _reports(f"""
SELECT safetyreportid, {O.day('receivedate')} AS receivedate_clean, {O.day('transmissiondate')} AS transmissiondate_clean,
  {O.day('receiptdate')} AS receiptdate_clean FROM reports"""))
def clean_dates(t: Tables) -> DataFrame:
    return cleaning.clean_dates(t.reports).select(ID, *[f"{c}_clean" for c in cleaning.DATE_COLUMNS])


@query("age_group_v1", _reports(f"SELECT safetyreportid, {O.AGE_LABEL} AS age_group FROM reports"))
def age_group_v1(t: Tables) -> DataFrame:
    rows = columns.with_numbers(t.reports, ["patientonsetage"])
    return rows.select(ID, bands.age_group_label(F.col("_n_patientonsetage")).alias("age_group"))


@query("age_group_v2", _reports(
    f"SELECT safetyreportid, {O.coded('patientonsetage', 18, 40, 65)} AS age_group FROM reports"))
def age_group_v2(t: Tables) -> DataFrame:
    rows = columns.with_numbers(t.reports, ["patientonsetage"])
    return rows.select(ID, bands.age_group_code(F.col("_n_patientonsetage")).alias("age_group"))


@query("weight_group_v2", _reports(
    f"SELECT safetyreportid, {O.coded('patientweight', 50, 70, 90)} AS weight_group FROM reports"))
def weight_group_v2(t: Tables) -> DataFrame:
    rows = columns.with_numbers(t.reports, ["patientweight"])
    return rows.select(ID, bands.weight_group_code(F.col("_n_patientweight")).alias("weight_group"))


@query("severity_v1", O.using("clean", body="SELECT safetyreportid, outcome_severity FROM clean"))
def severity_v1(t: Tables) -> DataFrame:
    return cleaning.clean_reports(t.reports).select(ID, "outcome_severity")


@query("severity_v2", O.using("features_v2", body="SELECT safetyreportid, outcome_severity FROM features_v2"))
def severity_v2(t: Tables) -> DataFrame:
    return t.reports.select(ID, features.training_severity(t.reports).alias("outcome_severity"))


@query("reporting_lag", _reports(f"SELECT safetyreportid, {O.LAG} AS reporting_lag_days FROM reports"))
def reporting_lag(t: Tables) -> DataFrame:
    return cleaning.clean_reports(t.reports).select(ID, "reporting_lag_days")


@query("report_month_year", _reports(f"""
SELECT safetyreportid, CAST(COALESCE(month({O.day('receiptdate')}), 0) AS INTEGER) AS report_month,
  CAST(COALESCE(year({O.day('receiptdate')}), 0) AS INTEGER) AS report_year FROM reports"""))
def report_month_year(t: Tables) -> DataFrame:
    day = dates.report_day("receiptdate")
    return t.reports.select(
        ID, dates.report_month(day).alias("report_month"), dates.report_year(day).alias("report_year"))


@query("column_counts_v2", O.using("features_v2", body="SELECT safetyreportid, drug_count, reaction_count FROM features_v2"))
def column_counts_v2(t: Tables) -> DataFrame:
    return t.reports.select(ID, *[c.alias(n) for n, c in features.column_counts(t.reports).items()])


@query("patient_risk_v1", O.using("features_v1", body=
       "SELECT safetyreportid, round(patient_risk_score, 6) AS patient_risk_score FROM features_v1"))
def patient_risk_v1(t: Tables) -> DataFrame:
    score = risk.patient_risk_from_groups(F.col("age_group"), F.col("outcome_severity"))
    return _cleaned(t).select(ID, F.round(score, 6).alias("patient_risk_score"))


@query("drug_risk_v1", _reports(f"""
SELECT safetyreportid, round(CAST(1.0 AS DOUBLE) + (drug_count - 1) * CAST(0.1 AS DOUBLE), 6) AS drug_risk_score
FROM reports"""))
def drug_risk_v1(t: Tables) -> DataFrame:
    return t.reports.select(ID, F.round(risk.drug_risk_from_count(F.col("drug_count")), 6).alias("drug_risk_score"))


@query("patient_risk_v2", O.using("training", body=
       "SELECT safetyreportid, round(patient_risk_score, 6) AS patient_risk_score FROM training"))
def patient_risk_v2(t: Tables) -> DataFrame:
    rows = columns.with_numbers(t.reports, ["patientonsetage"]).withColumn(
        "age_group", bands.age_group_code(F.col("_n_patientonsetage")))
    return rows.select(
        ID, F.round(risk.patient_risk_from_codes(F.col("age_group"), F.col("reaction_count")), 6).alias("patient_risk_score"))


@query("drug_risk_v2", O.using("training", body=
       "SELECT safetyreportid, round(drug_risk_score, 6) AS drug_risk_score FROM training"))
def drug_risk_v2(t: Tables) -> DataFrame:
    return t.reports.select(ID, F.round(risk.drug_risk_clipped(F.col("drug_count")), 6).alias("drug_risk_score"))


@query("phase_numeric", O.using("clean_trials", body="SELECT nctId, phase_numeric FROM clean_trials"))
def phase_numeric(t: Tables) -> DataFrame:
    return t.studies.select("nctId", trials.phase_number("phase").alias("phase_numeric"))


@query("status_category", O.using("clean_trials", body="SELECT nctId, status_category FROM clean_trials"))
def status_category(t: Tables) -> DataFrame:
    return t.studies.select("nctId", trials.status_category("overallStatus").alias("status_category"))


@query("trial_years", O.using("clean_trials", body="SELECT nctId, startDate_year, completionDate_year FROM clean_trials"))
def trial_years(t: Tables) -> DataFrame:
    return t.studies.select(
        "nctId", dates.study_year("startDate").alias("startDate_year"),
        dates.study_year("completionDate").alias("completionDate_year"))


@query("clean_trials", O.using("clean_trials", body="SELECT * FROM clean_trials"))
def clean_trials(t: Tables) -> DataFrame:
    return cleaning.clean_trials(t.studies)


@query("ascii_clean", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\x00-\x7F]+', '', 'g'),
  '[\t\n\x0B\f\r\x1C-\x1F ]+', ' ', 'g')) AS clean FROM documents""")
def ascii_clean(t: Tables) -> DataFrame:
    return t.table("documents").select("doc_id", ascii_only("text").alias("clean"))


# Cleaned reports and feature tables

def _cleaned(t: Tables) -> DataFrame:
    with_patient = t.reports.withColumn("patient", F.struct("patientonsetage", "patientweight"))
    return cleaning.clean_reports(with_patient)


@query("clean_reports", O.using("clean", body="SELECT * FROM clean"))
def clean_reports(t: Tables) -> DataFrame:
    return _cleaned(t)


@query("clean_reports_flat", O.using("clean", body="""
SELECT safetyreportid, is_serious, serious, receivedate, 'unknown' AS age_group, gender, weight_group, primary_drug,
  0 AS drug_count, primary_reaction, 0 AS reaction_count, outcome_severity, reporting_lag_days, transmissiondate,
  primarysourcecountry, occurcountry FROM clean"""))
def clean_reports_flat(t: Tables) -> DataFrame:
    return cleaning.clean_reports(t.reports)


def _features_v1(t: Tables) -> DataFrame:
    return cleaning.features_v1(_cleaned(t), with_patient=True)


def _round_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("patient_risk_score", "drug_risk_score")})


_ROUND_SQL = ("* REPLACE (round(patient_risk_score, 6) AS patient_risk_score, "
              "round(drug_risk_score, 6) AS drug_risk_score)")


@query("features_v1", O.using("features_v1", body=f"SELECT {_ROUND_SQL} FROM features_v1"))
def features_v1(t: Tables) -> DataFrame:
    return _round_scores(_features_v1(t))


def _features_v2(t: Tables) -> DataFrame:
    return features.features_v2(t.reports, TRAINING)


def training_features(t: Tables) -> DataFrame:
    """Training table with the reports' own dates and counts."""
    return features.features_v2(t.reports, TRAINING, calendar="actual", counts="given")


def stored_training(t: Tables) -> DataFrame:
    """The training table, written once: the split reads it twice."""
    path = scratch_dir(t.spark, "training")
    with compilable_code(t.spark):
        training_features(t).write.parquet(path)
    return t.spark.read.parquet(path)


@query("features_v2", O.using("features_v2", body=f"SELECT {_ROUND_SQL} FROM features_v2"))
def features_v2(t: Tables) -> DataFrame:
    return _round_scores(_features_v2(t))


@query("features_v2_actual", O.using("training", body=f"SELECT {_ROUND_SQL} FROM training"))
def features_v2_actual(t: Tables) -> DataFrame:
    return _round_scores(training_features(t))


@query("training_table", O.using("training_nested", body=f"SELECT {_ROUND_SQL} FROM training_nested"))
def training_table(t: Tables) -> DataFrame:
    return _round_scores(features.training_table(t.reports_nested))


@query("bin_violations", _reports(f"""
SELECT COUNT(*) FILTER (WHERE {O.number('patientonsetage')} < -1) AS age_below_bands,
  COUNT(*) FILTER (WHERE {O.number('patientweight')} < -1) AS weight_below_bands FROM reports"""))
def bin_violations(t: Tables) -> DataFrame:
    return features.bin_violations(t.reports, TRAINING)


_NARROWED = {
    "is_serious": "TINYINT", "reporting_lag_days": "SMALLINT", "report_month": "TINYINT", "report_year": "SMALLINT",
    "weight_group": "TINYINT", "age_group": "TINYINT", "drug_count": "TINYINT", "reaction_count": "TINYINT",
    "outcome_severity": "TINYINT", "occurcountry_encoded": "TINYINT", "primarysourcecountry_encoded": "TINYINT",
    "primary_drug_encoded": "TINYINT", "primary_reaction_encoded": "TINYINT",
}


@query("narrow_integers", O.using("training", body="SELECT safetyreportid, " + ", ".join(
    f"CAST({c} AS {kind}) AS {c}" for c, kind in _NARROWED.items()) + ", '" + ",".join(
    f"{c}:{kind.lower()}" for c, kind in sorted(_NARROWED.items())) + "' AS types FROM training"))
def narrow_integers(t: Tables) -> DataFrame:
    """All integer columns of the training table, with the types that they were given."""
    narrow = columns.narrow_integers(training_features(t))
    integers = {f.name: f.dataType.simpleString() for f in narrow.schema.fields
                if f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")}
    types = ",".join(f"{c}:{kind}" for c, kind in sorted(integers.items()))
    return narrow.select(ID, *integers, F.lit(types).alias("types"))


@query("score_features", O.using("event_fields", body="""
SELECT event_id, """ + ", ".join(
    f"COALESCE(CASE WHEN isnan(try_cast({c} AS DOUBLE)) THEN NULL ELSE try_cast({c} AS DOUBLE) END, 0) AS {c}"
    for c in features.K.MODEL_FEATURES) + " FROM event_fields"))
def score_features(t: Tables) -> DataFrame:
    return features.score_features(t.event_fields).select("event_id", *features.K.MODEL_FEATURES)


# Encodings

@query("one_hot_age_group", O.using("features_v1", body="""
SELECT safetyreportid, age_group_adult, age_group_child, age_group_middle_age, age_group_senior,
  age_group_young_adult, age_group_nan FROM features_v1"""))
def one_hot_age_group(t: Tables) -> DataFrame:
    rows = columns.with_numbers(t.reports, ["patientonsetage"])
    labelled = rows.select(ID, bands.age_group_label(F.col("_n_patientonsetage")).alias("age_group"))
    return encoding.one_hot(labelled, "age_group", features.K.CLEANER_AGE_LABELS)


@query("one_hot_country", _reports("SELECT safetyreportid, " + ", ".join(
    f"COALESCE(occurcountry = 'NATION_{i}', FALSE) AS \"occurcountry_NATION_{i}\"" for i in range(25))
    + ", occurcountry IS NULL AS occurcountry_nan FROM reports"))
def one_hot_country(t: Tables) -> DataFrame:
    return encoding.one_hot(t.reports.select(ID, "occurcountry"), "occurcountry", [f"NATION_{i}" for i in range(25)])


def _top_sql(column: str, n: int) -> str:
    return _reports(f"""SELECT safetyreportid, {O.code_of(column, 'c')} AS code FROM reports
LEFT JOIN ({O.top_codes(column, n)}) c ON COALESCE({column}, 'UNKNOWN') = c.v""")


def _top(t: Tables, column: str, n: int) -> DataFrame:
    reports = t.reports.select(ID, column)
    known = reports.withColumn("_known", encoding.dictionaries(reports, {column: n}))
    return known.select(ID, encoding.top_n_codes(F.col("_known"), [column])[column].alias("code"))


@query("topn_country", _top_sql("occurcountry", 5))
def topn_country(t: Tables) -> DataFrame:
    return _top(t, "occurcountry", features.K.TOP_COUNTRIES)


@query("topn_drug", _top_sql("medicinalproduct", 10))
def topn_drug(t: Tables) -> DataFrame:
    return _top(t, "medicinalproduct", features.K.TOP_DRUGS)


@query("topn_reaction", _top_sql("reactionmeddrapt", 15))
def topn_reaction(t: Tables) -> DataFrame:
    return _top(t, "reactionmeddrapt", features.K.TOP_REACTIONS)


@query("brand_to_generic", O.using("branded", body="""
SELECT p_partkey, CASE lower(drug_name) WHEN 'advil' THEN 'ibuprofen' WHEN 'tylenol' THEN 'acetaminophen'
  WHEN 'motrin' THEN 'ibuprofen' WHEN 'aleve' THEN 'naproxen' WHEN 'aspirin' THEN 'aspirin'
  ELSE lower(drug_name) END AS generic FROM branded"""))
def brand_to_generic(t: Tables) -> DataFrame:
    return t.branded.select("p_partkey", encoding.generic_name("drug_name").alias("generic"))


@query("serious_outcome_codes", O.using("outcomes", body="""
SELECT primaryid, outc_cod FROM outcomes WHERE outc_cod IN ('DE', 'LT', 'HO', 'DS', 'CA', 'RI')"""))
def serious_outcome_codes(t: Tables) -> DataFrame:
    return t.outcomes.where(encoding.is_serious_outcome("outc_cod"))
