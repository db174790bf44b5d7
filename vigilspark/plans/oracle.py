"""SQL building blocks of the checks: derived inputs and shared steps as common table expressions."""

from __future__ import annotations

from .tables import INPUTS, input_sql


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def number(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def day(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y%m%d') AS DATE)"


def yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _weighted(*cases: tuple[str, float]) -> str:
    whens = " ".join(f"WHEN {c} THEN {_d(w)}" for c, w in cases)
    return f"(CASE {whens} ELSE {_d(0.0)} END)"


def _rule_score(src: str) -> str:
    """Rule columns over an input with numeric flags and numbers."""
    return f"""
SELECT *, LEAST({_d(0.0)} + {_weighted(("f_death=1", 1.0))} + {_weighted(("f_life=1", 0.9))}
    + {_weighted(("f_hosp=1", 0.7))} + {_weighted(("f_dis=1", 0.6))} + {_weighted(("f_cong=1", 0.5))}
    + {_weighted(("age>65", 0.2), ("age<18 AND age>0", 0.25))}
    + {_weighted(("drugs>5", 0.3), ("drugs>3", 0.15))} + {_weighted(("reactions>3", 0.2))}
    + {_weighted(("severity>7", 0.3))}, {_d(1.0)}) AS risk_score,
  concat_ws(', ', CASE WHEN f_death=1 THEN 'death' END, CASE WHEN f_life=1 THEN 'life_threatening' END,
    CASE WHEN f_hosp=1 THEN 'hospitalization' END, CASE WHEN f_dis=1 THEN 'disabling' END,
    CASE WHEN f_cong=1 THEN 'birth_defect' END,
    CASE WHEN age>65 THEN 'elderly' WHEN age<18 AND age>0 THEN 'pediatric' END,
    CASE WHEN drugs>5 THEN 'multiple_drugs' WHEN drugs>3 THEN 'several_drugs' END,
    CASE WHEN reactions>3 THEN 'multiple_reactions' END,
    CASE WHEN severity>7 THEN 'high_severity_score' END) AS risk_factors
FROM {src}"""


_AGE = number("patientonsetage")
AGE_LABEL = (
    f"CASE WHEN {_AGE} < 0 THEN 'nan' WHEN {_AGE} <= 18 THEN 'child' WHEN {_AGE} <= 35 THEN 'young_adult' "
    f"WHEN {_AGE} <= 50 THEN 'adult' WHEN {_AGE} <= 65 THEN 'middle_age' WHEN {_AGE} <= 100 THEN 'senior' "
    f"ELSE 'nan' END"
)


def coded(value: str, a: int, b: int, c: int) -> str:
    v = f"COALESCE({number(value)}, 0)"
    return (
        f"CASE WHEN {v} < -1 THEN NULL WHEN {v} <= {a} THEN 0 WHEN {v} <= {b} THEN 1 WHEN {v} <= {c} THEN 2 ELSE 3 END"
    )


def top_codes(column: str, n: int) -> str:
    return f"""SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v ASC) AS INTEGER) AS r FROM (
  SELECT COALESCE({column}, 'UNKNOWN') AS v, COUNT(*) AS n FROM reports GROUP BY 1 ORDER BY n DESC, v ASC LIMIT {n}) t"""


def code_of(column: str, alias: str) -> str:
    return (
        f"CAST(CASE WHEN COALESCE({column}, 'UNKNOWN') = 'UNKNOWN' THEN 0 ELSE COALESCE({alias}.r, 0) END AS INTEGER)"
    )


SEVERITY_V1 = " + ".join(
    f"({yes(number(c) + ' = 1')})"
    for c in ("seriousnessdeath", "seriousnesshospitalization", "seriousnesslifethreatening", "seriousnessdisabling")
)
SEVERITY_V2 = " + ".join(
    f"COALESCE(try_cast({c} AS INTEGER), 0)"
    for c in ("seriousnessdeath", "seriousnesslifethreatening", "seriousnesshospitalization")
)
LAG = f"CAST(COALESCE(date_diff('day', {day('receiptdate')}, {day('receivedate')}), 0) AS INTEGER)"
_CODES = [
    ("occurcountry", "c1", 5), ("primarysourcecountry", "c2", 5), ("medicinalproduct", "c3", 10),
    ("reactionmeddrapt", "c4", 15),
]


def _features_v2(lag: str, month: str, year: str, drugs: str, reactions: str) -> str:
    joins = " ".join(f"LEFT JOIN ({top_codes(c, n)}) {a} ON COALESCE({c}, 'UNKNOWN') = {a}.v" for c, a, n in _CODES)
    codes = [code_of(c, a) for c, a, _ in _CODES]
    age, weight = coded("patientonsetage", 18, 40, 65), coded("patientweight", 50, 70, 90)
    risk_of_age = f"CASE {age} WHEN 1 THEN 2 WHEN 3 THEN 2 ELSE 1 END"
    return f"""
SELECT safetyreportid, {yes("serious = '1'")} AS is_serious, COALESCE({number('serious')}, 0) AS serious,
  receivedate, transmissiondate, {lag} AS reporting_lag_days, {month} AS report_month, {year} AS report_year,
  {weight} AS weight_group, {age} AS age_group, {drugs} AS drug_count, {reactions} AS reaction_count,
  {SEVERITY_V2} AS outcome_severity,
  (CAST({risk_of_age} AS DOUBLE) + GREATEST(LEAST({_d(reactions)} / {_d(5)}, {_d(2)}), {_d(0)})) / {_d(2)} AS patient_risk_score,
  GREATEST(LEAST({_d(drugs)} / {_d(3)}, {_d(2)}), {_d(0)}) AS drug_risk_score,
  {codes[0]} AS occurcountry_encoded, {codes[1]} AS primarysourcecountry_encoded,
  {codes[2]} AS primary_drug_encoded, {codes[3]} AS primary_reaction_encoded
FROM reports {joins}"""


# All drugs and reactions of a report, counted from the line items.
_LISTED = """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS listed_id, list_sort(list_distinct(list(p_name))) AS drugs,
  list_sort(list_distinct(list(p_type))) AS reactions
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""


def _listed(names: str) -> str:
    return f"CAST(COALESCE(len({names}), 0) AS INTEGER)"


# Columns of the flattened input whose names contain 'drug' or 'reaction'.
_COUNTED_DRUGS = yes("drug_count IS NOT NULL")
_COUNTED_REACTIONS = f"({yes('reaction_count IS NOT NULL')}) + ({yes('reactionmeddrapt IS NOT NULL')})"

_RULE_REPORTS = f"""
SELECT safetyreportid AS event_id, safetyreportid, {yes("seriousnessdeath='1'")} AS f_death,
  {yes("seriousnesslifethreatening='1'")} AS f_life, {yes("seriousnesshospitalization='1'")} AS f_hosp,
  {yes("seriousnessdisabling='1'")} AS f_dis, {yes("seriousnesscongenitalanomali='1'")} AS f_cong,
  COALESCE({_AGE}, 0) AS age, drug_count AS drugs, reaction_count AS reactions, outcome_severity AS severity,
  {yes("serious='1'")} AS is_serious
FROM reports"""

_RULE_EVENT_INPUT = """
SELECT event_id, COALESCE(safetyreportid, 'UNKNOWN') AS safetyreportid, ts, seriousnessdeath AS f_death,
  COALESCE(seriousnesslifethreatening, 0) AS f_life, seriousnesshospitalization AS f_hosp,
  seriousnessdisabling AS f_dis, seriousnesscongenitalanomali AS f_cong, COALESCE(patient_age, 0) AS age,
  COALESCE(drug_count, 1) AS drugs, COALESCE(reaction_count, 1) AS reactions, outcome_severity AS severity
FROM rule_events"""

LEVEL = f"CASE WHEN risk_score >= {_d(0.8)} THEN 'HIGH' WHEN risk_score >= {_d(0.5)} THEN 'MEDIUM' ELSE 'LOW' END"

_CLEAN = f"""
SELECT safetyreportid, {yes(number('serious') + ' = 1')} AS is_serious, {number('serious')} AS serious, receivedate,
  {AGE_LABEL} AS age_group, 'unknown' AS gender, 'unknown' AS weight_group, 'unknown' AS primary_drug,
  1 AS drug_count, 'unknown' AS primary_reaction, 1 AS reaction_count, {SEVERITY_V1} AS outcome_severity,
  {LAG} AS reporting_lag_days, transmissiondate, primarysourcecountry, occurcountry
FROM reports"""

_FEATURES_V1 = f"""
SELECT safetyreportid, is_serious, COALESCE(serious, 0) AS serious, COALESCE(receivedate, '0') AS receivedate,
  weight_group, drug_count, reaction_count, outcome_severity, reporting_lag_days,
  COALESCE(transmissiondate, '0') AS transmissiondate, COALESCE(primarysourcecountry, '0') AS primarysourcecountry,
  COALESCE(occurcountry, '0') AS occurcountry, age_group = 'adult' AS age_group_adult,
  age_group = 'child' AS age_group_child, age_group = 'middle_age' AS age_group_middle_age,
  age_group = 'senior' AS age_group_senior, age_group = 'young_adult' AS age_group_young_adult,
  age_group = 'nan' AS age_group_nan, TRUE AS gender_unknown, FALSE AS gender_nan, TRUE AS primary_drug_unknown,
  FALSE AS primary_drug_nan, TRUE AS primary_reaction_unknown, FALSE AS primary_reaction_nan,
  (CASE WHEN age_group = 'senior' THEN {_d(0.3)} ELSE {_d(0.0)} END)
    + (CASE WHEN age_group = 'middle_age' THEN {_d(0.2)} ELSE {_d(0.0)} END)
    + outcome_severity * {_d(0.5)} AS patient_risk_score,
  {_d(1.0)} + (drug_count - 1) * {_d(0.1)} AS drug_risk_score,
  CAST(COALESCE(month({day('receivedate')}), 0) AS INTEGER) AS report_month,
  CAST(COALESCE(year({day('receivedate')}), 0) AS INTEGER) AS report_year
FROM clean"""

_CLEAN_TRIALS = """
SELECT nctId, briefTitle, phase, studyType, overallStatus, startDate, completionDate, enrollment,
  CASE WHEN regexp_matches(lower(phase), 'phase ?1') THEN 1 WHEN regexp_matches(lower(phase), 'phase ?2') THEN 2
       WHEN regexp_matches(lower(phase), 'phase ?3') THEN 3 WHEN regexp_matches(lower(phase), 'phase ?4') THEN 4
       ELSE 0 END AS phase_numeric,
  COALESCE(try_cast(enrollment AS DOUBLE), 0) AS enrollment_clean,
  CASE WHEN overallStatus IS NULL THEN 'unknown' WHEN lower(overallStatus) LIKE '%completed%' THEN 'completed'
       WHEN lower(overallStatus) LIKE '%recruiting%' OR lower(overallStatus) LIKE '%active%' THEN 'active'
       WHEN lower(overallStatus) LIKE '%terminated%' OR lower(overallStatus) LIKE '%withdrawn%' THEN 'terminated'
       ELSE 'other' END AS status_category,
  lower(COALESCE(studyType, 'unknown')) AS study_type_clean,
  CASE WHEN try_cast(regexp_extract(startDate, '([0-9]{4})', 1) AS INTEGER) BETWEEN 1990 AND 2030
       THEN try_cast(regexp_extract(startDate, '([0-9]{4})', 1) AS INTEGER) END AS startDate_year,
  CASE WHEN try_cast(regexp_extract(completionDate, '([0-9]{4})', 1) AS INTEGER) BETWEEN 1990 AND 2030
       THEN try_cast(regexp_extract(completionDate, '([0-9]{4})', 1) AS INTEGER) END AS completionDate_year
FROM studies"""

_STUDY_RECORDS = """
SELECT nctId, briefTitle, COALESCE(phase, '') AS phase, COALESCE(studyType, '') AS studyType,
  COALESCE(overallStatus, '') AS overallStatus, COALESCE(startDate, '') AS startDate,
  COALESCE(completionDate, '') AS completionDate, COALESCE(try_cast(enrollment AS BIGINT), 0) AS enrollment,
  array_to_string(list_slice(string_split(interventions_text, '|'), 1, 3), ', ') AS interventions,
  COALESCE(array_to_string(list_slice(string_split(conditions_text, '|'), 1, 3), ', '), '') AS conditions,
  string_split(phase, ', ') AS phases, string_split(interventions_text, '|') AS intervention_list,
  startDate AS raw_start
FROM studies"""

# Name: (names it builds on, text).
STEPS: dict[str, tuple[list[str], str]] = {
    **{name: ([], input_sql(name)) for name in INPUTS},
    "clean": (["reports"], _CLEAN),
    "features_v1": (["clean"], _FEATURES_V1),
    "features_v2": (["reports"], _features_v2("30", "1", "2024", _COUNTED_DRUGS, _COUNTED_REACTIONS)),
    "training": (["reports"], _features_v2(
        LAG, f"CAST(COALESCE(month({day('receivedate')}), 0) AS INTEGER)",
        f"CAST(COALESCE(year({day('receivedate')}), 0) AS INTEGER)", "drug_count", "reaction_count",
    )),
    "listed": ([], _LISTED),
    "reports_listed": (["reports", "listed"],
                       "SELECT reports.*, drugs, reactions FROM reports LEFT JOIN listed ON safetyreportid = listed_id"),
    "training_nested": (["reports_listed"], _features_v2(
        LAG, f"CAST(COALESCE(month({day('receivedate')}), 0) AS INTEGER)",
        f"CAST(COALESCE(year({day('receivedate')}), 0) AS INTEGER)",
        _listed("drugs"), _listed("reactions"),
    ).replace("FROM reports", "FROM reports_listed")),
    "rule_input": (["reports"], _RULE_REPORTS),
    "ruled": (["rule_input"], _rule_score("rule_input")),
    "rule_event_input": (["rule_events"], _RULE_EVENT_INPUT),
    "ruled_events": (["rule_event_input"], _rule_score("rule_event_input")),
    "clean_trials": (["studies"], _CLEAN_TRIALS),
    "study_records": (["studies"], _STUDY_RECORDS),
}


def using(*names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """A query body with the steps it names, what those build on, and ``extra`` steps of its own in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in STEPS[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    steps = [(n, STEPS[n][1]) for n in ordered] + list((extra or {}).items())
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in steps) + "\n" + body
