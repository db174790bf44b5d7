"""Nested flattening, searches, encodings, profiles and store operators against brute force."""

import collections
import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from vigilspark.operators import encoding, filters, nested, profile, ranking, store
from vigilspark.operators.columns import named


def test_json_normalize(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("x"), F.struct(F.lit(2).alias("z")).alias("q"), F.array(F.lit(3)).alias("d")).alias("p"),
        F.lit("t").alias("top"))
    flat = nested.json_normalize(df)
    assert flat.columns == ["p.x", "p.q.z", "p.d", "top"]
    assert list(flat.first()) == [1, 2, [3], "t"]


def test_flatten_first(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": ["u"]}, [{"k": "x"}, {"k": "y"}], ["s1", "s2"], "later"), (None, [], [], None)],
        "p struct<a: string, b: array<string>>, l array<struct<k: string>>, s array<string>, l_k string")
    flat = nested.flatten_first(df)
    assert flat.columns == ["p_a", "p_b", "l_k", "s"]
    assert [tuple(r) for r in flat.collect()] == [("1", ["u"], "later", "s1"), (None, None, None, None)]


def reports(spark, rows):
    return spark.createDataFrame(rows, "safetyreportid string, receivedate string, serious string")


def test_windows_and_fallback(spark):
    df = reports(spark, [("1", "20240101", "1"), ("2", "20240331", "2"), ("3", "20240401", "1"), ("4", None, "1")])

    def ids(out):
        return sorted(r.safetyreportid for r in out.collect())

    assert ids(filters.filter_receive_window(df)) == ["1", "2"]
    assert ids(filters.filter_receive_window(df, "20240401", None)) == ["1", "2"]
    assert ids(filters.fetch_with_fallback(df, "20240401", "20240402")) == ["3"]
    assert ids(filters.fetch_with_fallback(df, "20250101", "20250102")) == ["1", "2", "3", "4"]
    assert ids(filters.fetch_with_fallback(df, terms=["serious:1"])) == ["1"]
    assert ids(filters.fetch_reports(df, "20250101", "20250102", limit=2)) == ["1", "2"]
    assert ids(filters.limit_reports(df, 3)) == ["1", "2", "3"]


def test_balanced_sample(spark):
    rows = [(f"{i:03d}", f"2024{1 + i % 12:02d}15", "1" if i % 3 else "2") for i in range(120)]
    got = filters.balanced_sample(reports(spark, rows), 30, 500).collect()
    want = []
    for code, n in (("1", 30), ("2", 500)):
        block = [r for r in rows if r[2] == code]
        block.sort(key=lambda r: (not ("20240101" <= r[1] <= "20240331"), r[1], r[0]))
        want += block[:n]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_ranks_and_running_sums(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(30) if i % 3 else 7, i, rng.randrange(4)) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, i int, n long").repartition(6)
    order = [F.col("k"), F.col("i")]
    want, total = [], 0
    for rank, (k, i, n) in enumerate(sorted(rows)):
        want.append((k, i, n, rank, total))
        total += n
    ranked = ranking.with_rank(df, order)
    assert sorted(map(tuple, ranked.collect())) == [w[:4] for w in want]
    assert sorted(map(tuple, ranking.with_running_sum(df, order, "n").collect())) == [(*w[:3], w[4]) for w in want]
    assert ranking.with_rank(df.limit(0), order).count() == 0


@pytest.mark.parametrize("n", [0, 1, 299, 300, 301, 555, 899, 900, 5000])
def test_first_rows_of_a_hot_value(spark, n):
    rows = [(7 if i % 3 == 0 else i % 10, f"{i % 450:04d}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, name string, i int").repartition(5)
    got = ranking.first_rows(df, {"_k": F.col("k")}, ["name"], n)
    want = sorted(rows, key=lambda r: (r[0], r[1]))[:n]
    assert got.columns == df.columns and sorted((r.k, r.name) for r in got.collect()) == sorted(r[:2] for r in want)
    if 0 < n < 900:
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_top_codes_match_brute_force_on_skewed_values(spark):
    rng = random.Random(7)
    values = ["HOT"] * 700 + [None] * 300 + [rng.choice("abcdefghijklmnop") for _ in range(1000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, x string, y string").repartition(5)
    counts = collections.Counter(v or "UNKNOWN" for v in values)
    ranked = [v for v, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))]

    def code(v, n):
        v = v or "UNKNOWN"
        return ranked.index(v) + 1 if v in ranked[:n] and v != "UNKNOWN" else 0

    got = coded(df, {"x": 5, "y": 12}).collect()
    assert all(r.x_code == code(r.x, 5) and r.y_code == code(r.y, 12) for r in got)
    assert code("HOT", 5) == 1 and ranked[1] == "UNKNOWN"


def coded(df, sizes):
    known = df.withColumn("_known", encoding.dictionaries(df, sizes))
    return known.withColumns({f"{n}_code": c for n, c in encoding.top_n_codes(F.col("_known"), sizes).items()})


def test_alerts_without_an_event_id_are_no_orphans(spark):
    alerts = spark.createDataFrame([("e1",), ("e9",), (None,)], "event_id string")
    events = spark.createDataFrame([("e1",)], "event_id string")
    assert [r.event_id for r in store.orphan_alerts(alerts, events).collect()] == ["e9"]
    assert {r.event_id for r in store.alerts_with_event(alerts, events).collect()} == {"e1", None}


def test_replay_on_another_day_under_dynamic_overwrite(spark, tmp_path):
    root = str(tmp_path / "store")
    store.create_tables(spark, root, ["adverse_events"])
    rows = spark.createDataFrame([(f"e{i}",) for i in range(10)], "event_id string")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2024-05-01", "2024-05-02"):
            store.append_batch(store.conform(rows, "adverse_events", F.lit(day).cast("timestamp")), root, "adverse_events", 0, "w")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert store.read_table(spark, root, "adverse_events").count() == 10
    store.append_batch(store.conform(rows, "adverse_events"), root, "adverse_events", 0, "other")
    assert store.read_table(spark, root, "adverse_events").count() == 20
    assert store.compact(spark, root, "adverse_events", str(tmp_path / "compact")).count() == 20


def test_alerts_need_type_and_level(spark, tmp_path):
    rows = store.conform(spark.createDataFrame([("e1", "HIGH")], "event_id string, alert_level string"), "safety_alerts")
    with pytest.raises(Exception, match="alert_type may not be null"):
        store.append_batch(rows, str(tmp_path), "safety_alerts", 0)


def test_top_codes_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    got = {r.x: r.x_code for r in coded(df, {"x": 2}).collect()}
    assert got == {"a": 1, "b": 2, "c": 0}


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "u"), (2, None), (3, "nan"), (4, "v")], "i int, f string")
    out = encoding.one_hot(df, "f", ["u", "v"]).orderBy("i")
    assert out.columns == ["i", "f_u", "f_v", "f_nan"]
    assert [tuple(r)[1:] for r in out.collect()] == [
        (True, False, False), (False, False, True), (False, False, True), (False, True, False)]


def test_brand_names_and_outcomes(spark):
    df = spark.createDataFrame([("Advil", "de"), ("Zyrtec", "OT"), (None, None)], "d string, o string")
    got = df.select(encoding.generic_name("d"), encoding.is_serious_outcome("o")).collect()
    assert [tuple(r) for r in got] == [("ibuprofen", True), ("zyrtec", False), (None, False)]


def test_profiles_of_one_row_and_none(spark):
    df = spark.createDataFrame([(1, 0.5, 2.0, 3)], "is_serious int, patient_risk_score double, drug_risk_score double, outcome_severity int")
    rows = {r.feature: r for r in profile.risk_profile(df).collect()}
    assert rows["patient_risk_score"]["std"] is None and rows["outcome_severity"]["max"] == 3.0
    empty = df.where("is_serious > 5")
    assert profile.data_quality_score(empty).first()[0] == 0.0
    assert profile.target_analysis(empty).first().serious_rate_percent is None
    assert profile.date_range(empty, F.lit(None).cast("date")).count() == 0
    assert profile.size_verdict(df).first().verdict == "too small"
    assert profile.target_analysis(df).first().class_balance == "balanced"


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, b string")
    assert {r.column_name: r.missing for r in profile.missing_by_column(df).collect()} == {"a": 1, "b": 1}
    assert profile.data_quality_score(df).first()[0] == 50.0


def test_running_minutes_match_brute_force(spark):
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(minutes=rng.randrange(5000)), rng.randrange(2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, serious int")
    got = profile.running_minute_summary(profile.minute_summary(df)).orderBy("minute").collect()
    n = s = 0
    for r, minute in zip(got, sorted({t for t, _ in rows})):
        n += sum(1 for t, _ in rows if t == minute)
        s += sum(x for t, x in rows if t == minute)
        assert (r.minute, r.total_events, r.total_serious) == (minute, n, s)
    assert n == 3000 and len(got) == len({t for t, _ in rows})


def test_insert_ignore_with_a_hot_key(spark):
    rng = random.Random(5)
    batch = [("hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(200)}"), i, f"v{i}") for i in range(900)]
    rng.shuffle(batch)
    stored = [(f"k{i}", "old") for i in range(100)] + [("k1", "old")]
    new = spark.createDataFrame(batch, "event_id string, created_at int, v string").repartition(6)
    out = store.insert_ignore(new, spark.createDataFrame(stored, "event_id string, v string"), "created_at")
    first = {}
    for key, at, v in sorted(batch, key=lambda r: r[1]):
        if key is not None:
            first.setdefault(key, (key, at, v))
    have = {k for k, _ in stored}
    want = [r for k, r in first.items() if k not in have] + [r for r in batch if r[0] is None]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_store_tables(spark, tmp_path):
    root = str(tmp_path / "store")
    store.create_tables(spark, root)
    rows = spark.createDataFrame([("e1", "20240230", "1"), ("e2", "20240301", "x")], "event_id string, receivedate string, serious string")
    now = F.lit("2024-05-01 00:00:00").cast("timestamp")
    for _ in range(2):  # writing a batch again leaves one copy
        store.append_batch(store.conform(rows, "adverse_events", now), root, "adverse_events", 7)
    store.create_tables(spark, root)  # an existing table is kept
    got = {r.event_id: r for r in store.read_table(spark, root, "adverse_events").collect()}
    assert set(got) == {"e1", "e2"}
    assert (got["e1"].receivedate, got["e1"].serious, got["e1"].ingest_batch) == (None, 1, "bulk-7")
    assert (got["e2"].receivedate, got["e2"].serious) == (datetime.date(2024, 3, 1), None)
    assert got["e1"].created_at == got["e1"].updated_at and got["e1"].created_at is not None
    alerts = spark.createDataFrame([("e1", "HIGH", "T")], "event_id string, alert_level string, alert_type string")
    store.append_batch(store.conform(alerts, "safety_alerts", now), root, "safety_alerts", 0)
    assert store.read_table(spark, root, "safety_alerts").first().is_reviewed is False
    assert store.read_table(spark, root, "system_metrics").count() == 0
    dashboard = store.recent_alerts(
        store.read_table(spark, root, "safety_alerts"), store.read_table(spark, root, "adverse_events"), as_of=now)
    assert [(r.event_id, r.safetyreportid, r.created_day) for r in dashboard.collect()] == [
        ("e1", None, datetime.date(2024, 5, 1))]
    scan = dashboard._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*isnotnull\(created_day", scan)


def test_keyed_insert_reads_the_buckets_of_its_keys(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = store.conform(spark.range(5000).select(F.format_string("e%d", "id").alias("event_id")), "adverse_events")
    store.append_batch(rows, root, "adverse_events", 0)
    batch = spark.createDataFrame([(f"e{i}",) for i in range(4995, 5005)] + [(None,)], "event_id string")
    keys = store.read_keys(spark, root, "adverse_events", batch)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*key_bucket#\d+ IN \(", plan) and "ReadSchema: struct<event_id:string>" in plan
    files = {f for f in keys.inputFiles()}
    wanted = {r.b for r in batch.where("event_id IS NOT NULL").select(store.key_bucket("event_id").alias("b")).collect()}
    read = keys.select(F.input_file_name().alias("f")).distinct().collect()
    assert 1 < len(wanted) <= 10 and len(read) <= len(wanted) < store.KEY_BUCKETS and len(files) >= len(read)
    fresh = store.insert_ignore(batch.withColumn("created_at", F.lit(1)), keys, "created_at")
    assert sorted((r.event_id or "") for r in fresh.collect()) == ["", "e5000", "e5001", "e5002", "e5003", "e5004"]


def test_tables_of_a_batch_appear_together(spark, tmp_path):
    root = str(tmp_path / "store")
    events = store.conform(spark.createDataFrame([("e1",), ("e2",)], "event_id string"), "adverse_events")
    alert = "event_id string, alert_type string, alert_level string"
    good = store.conform(spark.createDataFrame([("e1", "T", "HIGH")], alert), "safety_alerts")
    bad = store.conform(spark.createDataFrame([("e2", "T", None)], alert), "safety_alerts")

    def sizes():
        return [store.read_table(spark, root, n).count() for n in store.DAILY] + [
            store.read_keys(spark, root, n).count() for n in store.DAILY]

    store.create_tables(spark, root)
    with pytest.raises(Exception, match="alert_level may not be null"):
        store.write_batch({"adverse_events": events, "safety_alerts": bad}, root, 0)
    assert sizes() == [0, 0, 0, 0]

    def die():
        raise RuntimeError("died")

    with pytest.raises(RuntimeError, match="died"):
        store.write_batch({"adverse_events": events, "safety_alerts": good}, root, 0, before_commit=die)
    assert sizes() == [0, 0, 0, 0] and not store.is_committed(spark, root, store.DAILY, 0, "bulk")
    store.write_batch({"adverse_events": events, "safety_alerts": good}, root, 0)
    assert sizes() == [2, 1, 2, 1] and store.is_committed(spark, root, store.DAILY, 0, "bulk")
    store.append_batch(events, root, "adverse_events", 0)  # a batch of one table is another one
    assert sizes() == [4, 1, 4, 1]
    with pytest.raises(RuntimeError, match="died"):  # what a failed attempt replaces is not shown either
        store.write_batch({"adverse_events": events, "safety_alerts": good}, root, 0, before_commit=die)
    assert sizes() == [2, 0, 2, 0]


def test_recent_alerts_and_stats(spark):
    now = datetime.datetime(2024, 1, 3)
    hours = [1, 24, 25, 2]
    alerts = spark.createDataFrame(
        [(f"e{i}", "HIGH" if i % 2 == 0 else "LOW", now - datetime.timedelta(hours=h)) for i, h in enumerate(hours)],
        "event_id string, alert_level string, created_at timestamp_ntz")
    events = spark.createDataFrame(
        [("e0", "r0", "20240101", 1, now), ("e1", "r1", "20240101", 0, now - datetime.timedelta(days=3))],
        "event_id string, safetyreportid string, receivedate string, serious int, created_at timestamp_ntz")
    at = F.lit(now)
    assert [r.event_id for r in store.recent_alerts(alerts, events, as_of=at).collect()] == ["e0", "e1"]
    assert [r.event_id for r in store.recent_alerts(alerts, events, alert_level="HIGH", as_of=at).collect()] == ["e0"]
    assert tuple(store.system_stats(events, alerts, as_of=at).first()) == (2, 1, 4, 1, 1)
    assert sorted(r.event_id for r in store.orphan_alerts(alerts, events).collect()) == ["e2", "e3"]
    assert sorted(r.event_id for r in store.alerts_with_event(alerts, events).collect()) == ["e0", "e1"]


def test_named_handles_dots(spark):
    df = spark.range(1).select(F.lit(5).alias("a.b"))
    assert df.select(named("a.b")).first()[0] == 5
