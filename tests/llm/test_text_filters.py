"""Language ID, toxicity, PII and decontamination against brute force and held-out labels."""

import hashlib
import math
import random
import time
import re

import pytest
from pyspark.sql import functions as F

from vigilspark.llm import decontaminate, language, pii, queries, toxicity
from vigilspark.llm.common import read

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Language ID


def test_forward_sums_all_segmentations():
    rng = random.Random(0)
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "abc", "c", "▁ab"]
    table = {p: (rng.random() * 0.2, rng.random() * 0.2) for p in pieces}

    def brute(word, k):
        word = "▁" + word

        def go(i):
            if i == len(word):
                return 1.0
            total = sum(table[word[i:j]][k] * go(j) for j in range(i + 1, len(word) + 1) if word[i:j] in table)
            return total + (language.UNSEEN * go(i + 1) if word[i] not in table else 0.0)

        return math.log(go(0))

    words = ["".join(rng.choice("abcx") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    for word, got in language.forward(words, table, 2, 4):
        assert got == pytest.approx([brute(word, k) for k in range(2)])
    long = dict(language.forward(["abcab" * 400, "abcab" * 200], table, 2, 4))
    assert long["abcab" * 400][0] == pytest.approx(2 * long["abcab" * 200][0], rel=1e-2)


def test_language_held_out_accuracy(spark):
    docs = read(spark, SF, "documents")
    found = queries.op6_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


def test_language_odd_rows(spark):
    model = language.Model(["de", "en"], {"▁a": (0.5, 0.4), "a": (0.1, 0.2), "▁": (0.1, 0.1)}, "test")
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !? ²", "x"), (None, "a a", "x"), (5, "a" * 100_000, "x"), (5, "a" * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = rows_of(language.identify(docs, model).select("doc_id", "lang_pred", "score"))
    assert [x[1] for x in sorted(got, key=str)] == ["und", "und", "und", "en", "en", "de"]
    assert language.identify(docs.limit(0), model).count() == 0
    empty = language.fit(docs.limit(0).withColumn("lang", F.lit("de")))
    assert {x.lang_pred for x in language.identify(docs, empty).collect()} == {"und"}


def test_expected_pieces_of_long_words():
    rng = random.Random(1)
    table = {p: rng.random() * 0.1 for p in ["▁", "a", "b", "ab", "ba", "aab", "▁a"]}
    # Every letter lies in one piece, whatever the length of the word.
    for n in (3, 20, 400, 3000):
        counts = language.expected_pieces("ab" * n, table, 3)
        assert math.isclose(sum(len(p) * x for p, x in counts.items()), 2 * n + 1, rel_tol=1e-6)
    short, long = (language.expected_pieces("ab" * n, table, 3) for n in (60, 120))  # in numbers, and in logarithms
    longer = language.expected_pieces("ab" * 180, table, 3)
    for p in ("a", "ab", "ba"):
        assert math.isclose(longer[p] - long[p], long[p] - short[p], rel_tol=1e-6)


# Toxicity


def test_toxicity_held_out(spark):
    found = queries.op2_toxicity(spark, "/root/testdata/sf0.01").join(
        read(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    flagged = [r for r in found if r.predicted == 1]
    assert flagged and all(r.toxic == 1 for r in flagged)
    assert sum(r.predicted for r in found if r.toxic == 1) >= 0.6 * sum(r.toxic == 1 for r in found)


def test_machine_learns_a_pair():
    chosen = {k: k for k in range(4)}
    import numpy as np

    machine = toxicity.Machine(chosen, 0.0, np.zeros(4), np.random.default_rng(1).standard_normal((4, 8)) * 0.1)
    rows = [[0, 1], [0, 2], [1, 3], [0], [1], [2, 3]] * 50  # 0 and 1 together only
    machine.learn(rows, np.array([1.0, 0, 0, 0, 0, 0] * 50), 60, 0)
    scores = machine.scores(rows[:6])
    assert scores[0] > 0.7 and max(scores[1:]) < 0.5


def test_margins_are_sums_over_pairs():
    rng = random.Random(3)
    import numpy as np

    machine = toxicity.Machine({}, 0.3, np.array([rng.gauss(0, 1) for _ in range(9)]), np.random.default_rng(2).standard_normal((9, 8)))
    rows = [sorted(rng.sample(range(9), rng.randint(0, 9))) for _ in range(40)] + [[]]
    want = [0.3 + sum(machine.weights[i] for i in r) + sum(float(machine.factors[i] @ machine.factors[j]) for i in r for j in r if i < j)
            for r in rows]
    assert np.allclose(machine.margins(rows)[0], want)


def test_fit_learns_a_pair(spark):
    rng = random.Random(6)
    filler = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.4, rng.random() < 0.4  # toxic only together
        words = rng.choices(filler, k=12) + ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(docs.where("doc_id % 4 <> 0"), marks.where("doc_id % 4 <> 0"))
    held = toxicity.score(docs.where("doc_id % 4 = 0"), machine).join(marks, "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in held) > 0.97 * len(held)
    pair = machine.factors[machine.chosen[toxicity.terms("insult")[0]]] @ machine.factors[machine.chosen[toxicity.terms("group")[0]]]
    assert pair > 0


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3.0), (2, "", 3.0), (None, "x" * 200_000, 3.0)], "doc_id long, text string, score double")
    assert toxicity.fit(docs, docs.limit(0).select("doc_id", F.lit(1).alias("toxic"))) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    assert len(toxicity.op2_toxicity(spark, docs, labels).collect()) == 3


# PII

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_matches_the_plain_patterns(spark):
    rng = random.Random(0)
    texts = [None, "", "4111 1111 1111 1111", "4111-1111-1111-1111 x 378282246310005", "5500005555555559", "+1 (717) 555-0202",
             "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 000255.1.1.1 256.1.1.1 0.0.0.0", "joe@x.org " * 700, "12.3" * 200, "é😀 a@b.cd"]
    texts += ["".join(rng.choice("a@.1 +-_%é😀()4155") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(
        read(spark, SF, "documents").selectExpr("doc_id + 1000000", "text"))
    got = {r.doc_id: r for r in pii.op7_pii(spark, docs).collect()}
    for r in docs.collect():
        spans = brute_spans(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), r.text[:100]
        assert got[r.doc_id].n_email == spans.count("email:")


def test_pii_added_spans_context_and_redaction(spark):
    docs = spark.createDataFrame([(1, "account GB82 WEST 1234 5698 7654 32 or GB83 WEST 1234 5698 7654 32", "x"),
                                  (2, "call +1 (717) 555-0202 now", "x"), (3, "see +1 (717) 555-0202", "x"), (4, None, "x")],
                                 "doc_id long, text string, pii string")
    found = pii.find(docs)
    got = {r.doc_id: r for r in found.collect()}
    assert [(s.kind, s.start, s.end) for s in got[1].pii] == [("iban", 8, 35)]
    assert got[2].pii[0].score > got[3].pii[0].score and got[4].pii == []
    clean = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert clean[1].startswith("account <IBAN> or GB83") and clean[2] == "call <PHONE> now" and clean[4] is None
    assert pii.op7_pii(spark, docs.limit(0)).count() == 0
    # The score decides on the added kinds: a number of this form counts where words say what it is.
    numbers = spark.createDataFrame([(1, "SSN: 123-45-6789"), (2, "part 123-45-6789"), (3, "ssn 000-45-6789 or 123-45-67890"),
                                     (4, "her social security number is 219-09-9999, call +1 (717) 555-0202")], "doc_id long, text string")
    got = {r.doc_id: (r.spans, r.scores) for r in pii.op7_pii(spark, numbers).collect()}
    assert got[1] == ("ssn:5:16", "0.80") and got[2] == got[3] == ("", "")
    assert got[4] == ("phone:48:65,ssn:30:41", "0.80,0.80")
    assert [len(r.pii) for r in pii.find(numbers, min_score=0.0).orderBy("doc_id").collect()] == [1, 1, 0, 2]


def test_redaction_matches_brute_force_and_is_linear(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        n = rng.choice([0, 1, 5, 200, 300])
        body = "".join(rng.choice("aé\U0001f600 ") for _ in range(rng.choice([20, 3000])))
        spans = []
        for _ in range(n):
            a = rng.randrange(len(body))
            z = min(len(body), a + rng.randint(1, 12))
            spans.append((rng.choice(["ip", "card"]), a, z, body[a:z], 0.5))
        rows.append((i, body, spans))
    rows.append((100, None, []))
    schema = "doc_id long, text string, pii array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"

    def brute(body, spans):
        out, at = "", 0
        for kind, a, z, *_ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
            if a >= at:
                out, at = out + body[at:a] + f"<{kind.upper()}>", z
        return body if body is None else out + body[at:]

    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, schema)).collect()}
    assert got == {i: brute(body, spans) for i, body, spans in rows}
    many = spark.createDataFrame([(1, "write to a.b@example.org or 10.1.2.3 " * 30_000)], "doc_id long, text string")
    begun = time.time()
    text = pii.redact(pii.find(many)).first().text
    assert text == "write to <EMAIL> or <IP> " * 30_000 and time.time() - begun < 60


def test_pii_stays_in_the_jvm_without_a_shuffle(spark):
    plan = queries.op7_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_pii_is_linear_on_long_runs(spark):
    long = ["x" * 100_000 + "1" * 100_000, "a." * 50_000 + "@" + "b." * 50_000 + "c", "1 " * 100_000, "1." * 100_000, "+1" * 50_000,
            "AB12" + "A" * 200_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    assert [r.n_email for r in pii.op7_pii(spark, docs).orderBy("doc_id").collect()] == [0, 1, 0, 0, 0, 0]


# Decontamination


def test_items_of_frequent_words_keep_seeds():
    words = [f"w{i}" for i in range(40)]
    seeds = decontaminate.Seeds([(1, words)], dict.fromkeys(words, 0.02))  # copies of the item are most of the corpus
    assert len(seeds.hashes) >= decontaminate.LEAST_SEEDS
    for cut in range(40):  # one changed word takes three seeds at most
        text = " ".join(w if i != cut else "other" for i, w in enumerate(words))
        assert [x["item_id"] for x in seeds.leaks(text, 0.5)] == [1]


def items_and_docs():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(2000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, prose(30)) for i in range(10)]
    docs, truth = [], {}
    for d in range(60):
        body = prose(200)
        if d % 3:
            item, edited = d % 10, list(items[d % 10][1])
            if d % 3 == 2:  # every fifth word replaced, one left out
                edited = [rng.choice(words) if p % 5 == 2 else w for p, w in enumerate(edited)]
                del edited[13]
            body[50:50] = edited
            truth[d] = item
        docs.append((d, " ".join(body) if d % 2 else " ".join(body).upper() + "!"))
    return [(i, " ".join(w)) for i, w in items], docs, truth


def test_decontamination_finds_whole_and_edited_items(spark):
    items, docs, truth = items_and_docs()
    items += [(90, None), (91, "a b"), (None, "zz zy zx zw zv zu zt zs")]
    docs += [(100, None), (101, ""), (102, "zz zy zx zw zv zu zt zs"), (102, "zz zy zx zw zv zu zt zs"), (103, "the " * 20_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("leaks", F.lit("clash"))
    i = spark.createDataFrame(items, "item_id long, text string")
    for passes in (2_000_000, 100):
        found = decontaminate.annotate(d, i, pass_words=passes).select("doc_id", F.explode("leaks").alias("l")).collect()
        assert {r.doc_id: r.l.item_id for r in found if r.doc_id < 100} == truth
        assert sorted((r.doc_id, r.l.item_id) for r in found if r.doc_id >= 100) == [(102, None), (102, None)]
    assert decontaminate.op10_decontaminate(spark, d.limit(0), i).count() == 0
    assert decontaminate.op10_decontaminate(spark, d, i.limit(0)).count() == 0


def test_alignment_score_equals_full_dynamic_programming():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 20))
        table = np.zeros((len(a) + 1, len(b) + 1))
        for x in range(len(a)):
            for y in range(len(b)):
                table[x + 1, y + 1] = max(0, table[x, y] + (2 if a[x] == b[y] else -1), table[x, y + 1] - 1, table[x + 1, y] - 1)
        score, first, last = decontaminate.align(a, b)
        assert score == pytest.approx(table.max() / (2 * len(a)))
        assert 0 <= first <= last < len(b)


def test_decontamination_finds_every_whole_item_of_the_tables(spark):
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = {r.item_id: norm(r.text) for r in read(spark, SF, "benchmark").collect()}
    want = {(d.doc_id, i) for d in read(spark, SF, "documents").collect() for i, t in items.items() if t in norm(d.text)}
    got = {(r.doc_id, r.item_id) for r in queries.op10_decontaminate(spark, SF).collect()}
    assert want and want <= got
