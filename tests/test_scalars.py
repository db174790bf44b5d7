"""Number and date reading, bands at every edge, risk scores, text."""

import datetime
import math

from pyspark.sql import functions as F

from vigilspark.functions import bands, coerce, dates, risk, text
from vigilspark.operators import columns, features


def one(spark, kind, values, build):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(build(F.col("v"))).collect()]


def test_to_number(spark):
    given = ["1", " 2.5 ", "-3e2", "abc", "", None, "5d", "1.5f", "2D", "NaN", "inf", "-Infinity", "1.0", "1,000"]
    got = one(spark, "string", given, coerce.to_number)
    assert got == [1.0, 2.5, -300.0, None, None, None, None, None, None, None, math.inf, -math.inf, 1.0, None]


def test_number_of_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.5), (None, float("nan"))], "i int, d double")
    got = df.select(columns.number(df, "i"), columns.number(df, "d")).collect()
    assert [tuple(r) for r in got] == [(1.0, 2.5), (None, None)]


def test_serious_flags(spark):
    given = ["1", "1.0", "2", None, "x", " 1"]
    assert one(spark, "string", given, coerce.is_serious_numeric) == [1, 1, 0, 0, 0, 1]
    assert one(spark, "string", given, coerce.is_serious_text) == [1, 0, 0, 0, 0, 0]


def test_report_day(spark):
    given = ["20240229", " 20240101 ", "20230229", "20241301", "2024010", "202401011", "abcd0101", None, "20240101.0"]
    got = one(spark, "string", given, dates.report_day)
    assert got == [datetime.date(2024, 2, 29), datetime.date(2024, 1, 1)] + [None] * 7


def test_age_labels(spark):
    given = [-0.1, 0.0, 18.0, 18.1, 35.0, 50.0, 50.5, 65.0, 65.5, 100.0, 100.1, None]
    want = ["nan", "child", "child", "young_adult", "young_adult", "adult", "middle_age", "middle_age", "senior",
            "senior", "nan", "nan"]
    assert one(spark, "double", given, bands.age_group_label) == want


def test_training_bands(spark):
    given = [-1.5, -1.0, 0.0, 18.0, 18.5, 40.0, 40.5, 65.0, 65.5, math.inf, None]
    assert one(spark, "double", given, bands.age_group_code) == [None, 0, 0, 0, 1, 1, 2, 2, 3, 3, 0]
    given = [50.0, 50.1, 70.0, 70.1, 90.0, 90.1, None]
    assert one(spark, "double", given, bands.weight_group_code) == [0, 1, 1, 2, 2, 3, 0]


def test_patient_risk_by_codes(spark):
    df = spark.createDataFrame([(0, 5), (1, 20), (2, 0), (3, 1), (None, 0)], "a int, r int")
    got = [r[0] for r in df.select(risk.patient_risk_from_codes(F.col("a"), F.col("r"))).collect()]
    assert got == [1.0, 2.0, 0.5, 1.1, 0.5]
    got = one(spark, "int", [0, 3, 6, 9], risk.drug_risk_clipped)
    assert got == [0.0, 1.0, 2.0, 2.0]


def test_severities_differ(spark):
    df = spark.createDataFrame(
        [("1", "2", "1", "1", None), (None, "abc", "1.0", "1", "5")],
        "seriousnessdeath string, seriousnesslifethreatening string, seriousnesshospitalization string, "
        "seriousnessdisabling string, other_disability string")
    got = [r[0] for r in df.select(features.training_severity(df)).collect()]
    assert got == [4, 6]


def test_ascii_only(spark):
    given = ["café  au\tlait \n", "\U0001F9F9 Clean \x1d up", "", None, "é"]
    assert one(spark, "string", given, text.ascii_only) == ["caf au lait", "Clean up", "", None, ""]


def test_narrow_integers(spark):
    df = spark.createDataFrame([(1, 126, 127, 40000, 5), (-5, -127, -128, 0, 6)],
                               "safetyreportid bigint, a bigint, b bigint, c bigint, d int")
    kinds = {f.name: f.dataType.simpleString() for f in columns.narrow_integers(df).schema.fields}
    assert kinds == {"safetyreportid": "bigint", "a": "tinyint", "b": "smallint", "c": "bigint", "d": "tinyint"}
    empty = columns.narrow_integers(df.where("a > 1000"))
    assert {f.dataType.simpleString() for f in empty.schema.fields} == {"bigint", "int"}


def test_features_v2_without_optional_columns(spark):
    df = spark.createDataFrame([("r1",)], "safetyreportversion string")
    r = features.features_v2(df).first()
    assert r.safetyreportid == "r1" and len(r) == 19
    assert (r.is_serious, r.drug_count, r.reaction_count, r.outcome_severity) == (0, 1, 1, 0)
    assert (r.reporting_lag_days, r.report_month, r.report_year) == (30, 1, 2024)
    assert (r.age_group, r.weight_group, r.occurcountry_encoded, r.primary_drug_encoded) == (0, 0, 0, 0)


def test_bin_violations(spark):
    df = spark.createDataFrame([("-2", "5"), ("3", "-9"), (None, "x")], "patient_patientage string, patient_patientweight string")
    assert tuple(features.bin_violations(df).first()) == (1, 1)


def test_score_features(spark):
    df = spark.createDataFrame([("3", float("nan"), None), ("abc", 1.5, 7)], "drug_count string, patient_risk_score double, age_group int")
    rows = features.score_features(df).collect()
    assert [(r.drug_count, r.patient_risk_score, r.age_group, r.report_year) for r in rows] == [(3.0, 0.0, 0.0, 0.0), (0.0, 1.5, 7.0, 0.0)]
