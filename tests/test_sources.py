"""Landed pages, delimited text, CSV zones and file listings."""

import pytest
from pyspark.sql import types as T

from vigilspark import session
from vigilspark.operators import nested
from vigilspark.sources import faers, landing


def test_report_pages(spark, tmp_path):
    page = """{"meta": {"n": 2}, "results": [
      {"safetyreportid": "1", "serious": "1", "patient": {"patientonsetage": "40", "drug": [{"medicinalproduct": "A"}]}},
      {"safetyreportid": "2", "patient": {"reaction": []}}]}"""
    (tmp_path / "p1.json").write_text(page)
    (tmp_path / "p2.json").write_text('{"results": []}')
    (tmp_path / "p3.json").write_text('{"error": "none"}')
    rows = landing.read_report_pages(spark, str(tmp_path)).orderBy("safetyreportid").collect()
    assert [r.safetyreportid for r in rows] == ["1", "2"]
    assert rows[0].patient.drug[0].medicinalproduct == "A" and rows[1].patient.reaction == []


def test_pages_keep_fields_that_no_schema_declares(spark, tmp_path):
    (tmp_path / "p1.json").write_text("""{"meta": 1, "results": [
      {"id": "1", "a b": {"c.d": [1, 2.5], "none": null}, "mix": 1, "n": 5, "void": {}, "OBJECT": "o"},
      {"id": "2", "mix": "s", "OBJECT<q": {"VOID": true}, "list": [{"k": "v"}, {"l": 2}], "n": 10000000000}]}""")
    (tmp_path / "p2.json").write_text('{"results": [{"id": "3", "mix": {"x": 1}, "a b": {"late": "z"}}]}')
    for k, other in enumerate(['{"results": []}', '{"error": "none"}', '{"results": {"id": "no list"}}', '{"results": "text"}']):
        (tmp_path / f"q{k}.json").write_text(other)
    records = landing.read_page_records(spark, str(tmp_path))
    rows = {r.id: r.asDict(recursive=True) for r in nested.normalize_records(records).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert set(rows["1"]) == {"id", "a b.c.d", "a b.none", "a b.late", "mix", "n", "void", "OBJECT", "OBJECT<q.VOID", "list"}
    assert [float(x) for x in rows["1"]["a b.c.d"]] == [1.0, 2.5] and rows["1"]["void"] == "{}" and rows["1"]["OBJECT"] == "o"
    assert [rows[k]["mix"] for k in "123"] == ["1", '"s"', '{"x":1}'] and [rows[k]["n"] for k in "123"] == [5, 10000000000, None]
    assert rows["2"]["OBJECT<q.VOID"] is True and rows["2"]["list"] == [{"k": "v", "l": None}, {"k": None, "l": 2}]
    assert rows["3"]["a b.late"] == "z" and rows["3"]["a b.none"] is None
    some = nested.normalize_records(records, schema=T.StructType([T.StructField("id", T.StringType())]))
    assert sorted(r.id for r in some.collect()) == ["1", "2", "3"] and some.columns == ["id"]
    assert nested.normalize_records(records.limit(0)).columns == []


def test_study_pages(spark, tmp_path):
    (tmp_path / "s.json").write_text("""{"studies": [{"protocolSection": {
      "identificationModule": {"nctId": "N1"}, "designModule": {"phases": ["PHASE1", "PHASE2"]}}}, {}]}""")
    from vigilspark.operators.nested import study_records

    rows = study_records(landing.read_study_pages(spark, str(tmp_path))).orderBy("nctId").collect()
    assert [(r.nctId, r.phase, r.enrollment, r.conditions) for r in rows] == [("", "", 0, ""), ("N1", "PHASE1, PHASE2", 0, "")]


def test_faers_text(spark, tmp_path):
    lines = ["id$drug$dose", '1$"a$b"$5', "2$x", "3$y$6$surplus", "4$$", "5$café$7", '6$"p$q"$8$9$10']
    (tmp_path / "DRUG24Q1.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = faers.read_text_table(spark, str(tmp_path / "DRUG24Q1.txt"), ["id", "drug", "dose"])
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [("1", "a$b", "5"), ("2", "x", None), ("4", None, None), ("5", "café", "7")]
    assert rows.select("id").count() == 4


def test_faers_members(spark, tmp_path):
    for archive, names in {"faers_ascii_2024q1": ["DEMO24Q1.txt", "demo_old.txt", "README.pdf", "OUTC24Q1.txt"],
                           "faers_ascii_2024q2": ["reac24q2.txt"]}.items():
        (tmp_path / archive).mkdir()
        for name in names:
            (tmp_path / archive / name).write_text("x")
    got = sorted((r.archive, r.prefix, r.member, r.quarter, r.standard_name) for r in faers.members(spark, str(tmp_path)).collect())
    assert got == [
        ("faers_ascii_2024q1", "DEMO", "DEMO24Q1.txt", "2024q1", "demo_faers_ascii_2024q1.txt"),
        ("faers_ascii_2024q1", "OUTC", "OUTC24Q1.txt", "2024q1", "outc_faers_ascii_2024q1.txt"),
        ("faers_ascii_2024q2", "REAC", "reac24q2.txt", "2024q2", "reac_faers_ascii_2024q2.txt"),
    ]


def test_zones(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("a", 1), (None, 2), ("q,\"x\"", None)], "s string, n int")
    path = landing.zone_path(root, "raw", "t/x.csv")
    assert path == f"{root}/raw/t/x.csv" and landing.zone_path(root, "other", "k") == f"{root}/processed/k"
    landing.write_csv(df, path)
    back = landing.read_csv(spark, path, df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_csv_keeps_blanks_breaks_quotes_and_null(spark, tmp_path):
    values = [" a ", "", None, "two\nlines", 'say "hi"', "a,b", "back\\slash", "\t"]
    df = spark.createDataFrame(list(enumerate(values)), "n int, s string")
    landing.write_csv(df, str(tmp_path / "c"))
    assert [r.s for r in landing.read_csv(spark, str(tmp_path / "c"), df.schema).orderBy("n").collect()] == values


def test_faers_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.txt").write_text("id$drug$dose\n1$x$5\n")
    (tmp_path / "b.txt").write_text("dose$sex$ID\n7$F$2\n8\n9$M$3$more\n")
    rows = faers.read_text_table(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")], ["id", "drug", "dose"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("1", "x", "5"), ("2", None, "7"), (None, None, "8")], key=str)
    assert faers.read_text_table(spark, str(tmp_path / "b.txt")).columns == ["dose", "sex", "ID"]


def test_faers_files_of_many_headers_are_one_scan(spark, tmp_path):
    names = ["id", "drug", "dose", "route"]
    want = []
    for k in range(8):
        order = names[k % 4 :] + names[: k % 4] + [f"extra{k}"] * (k % 3)
        (tmp_path / f"f{k}.txt").write_text("$".join(order) + "\n" + "".join(
            "$".join(f"{c}-{k}-{i}" for c in order) + "\n" for i in range(5)))
        want += [tuple(f"{c}-{k}-{i}" for c in names) for i in range(5)]
    rows = faers.read_text_table(spark, str(tmp_path), names)
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 2  # the headers, and the lines


def test_scratch_folder(spark):
    assert session.scratch_dir(spark, "a") != session.scratch_dir(spark, "a")
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
