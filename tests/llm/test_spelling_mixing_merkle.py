"""Spelling variants, mixing and the Merkle manifest against brute force and against their SQL."""

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F
from vigilspark.llm import merkle, mixing, queries, spelling
from vigilspark.llm.common import read, running

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("name", ["op11_spelling", "op12_mixing", "op13_merkle"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    got = queries.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = con.sql(queries.ORACLES[name]).select(*names).fetchall()
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want)


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *"abcdé"]), rng.randrange(100), rng.randrange(5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, n long").repartition(5)
    order = [F.col("g").isNotNull(), F.col("g"), F.col("k")]
    got = running(df, order, "n", "before").orderBy("before").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sum(r.n for r in got) == sum(r[2] for r in rows) and Counter(map(tuple, (r[:3] for r in got))) == Counter(rows)
    total, spans = 0, {}
    for g, k, n in want:
        a, z = spans.get((g, k), (total, total))
        total += n
        spans[g, k] = (a, total)
    assert all(spans[r.g, r.k][0] <= r.before and r.before + r.n <= spans[r.g, r.k][1] for r in got)
    assert running(df.limit(0), order, "n", "before").count() == 0


# Spelling


def brute_words(rows):
    words = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                words[low] += 1
    return {w: n for w, n in words.items() if n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_variants(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


@pytest.mark.parametrize("symbols", [2, 4, 7])
def test_variants_match_brute_force(spark, symbols):
    rng = random.Random(symbols)
    base = ["".join(rng.choice("abcnéÿ") for _ in range(rng.randint(7, 10))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaa", "abababab"]
    words = {}
    for w in base:
        words[w] = rng.choice([3, 40, 500, 5000])
        for _ in range(12):
            v, i = list(w), rng.randrange(len(w))
            kind = rng.choice("-r+")
            v[i : i + (kind != "+")] = [] if kind == "-" else [rng.choice("abcnéÿ")]
            if len(v) >= 7:
                words.setdefault("".join(v), rng.choice([2, 4, 40, 41, 400]))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = [tuple(r) for r in spelling.variants(df, symbols=symbols).collect()]
    assert len(got) == len(words) and set(got) == brute_variants(words)
    pairs = [(r.a, r.b) for r in spelling.near_pairs(df, symbols=symbols).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})


def test_spelling_query(spark):
    rng = random.Random(9)
    words = ["ÀÉtrange", "Etrange", "etranges", "variant", "VARIANT", "varianİt", "short", "lettered", "KKelvins", "a×÷bcdef"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(None, "variant variant nullabled"), (None, "nullabled"), (5, None), (6, ""), (7, "x"), (8, "nothings9nothings"),
             (9, "longword, " * 150_000), (9, rows[3][1]), (9, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"word": F.lit("clash"), "n": F.lit(1)})
    assert {tuple(r) for r in spelling.op11_spelling(spark, df).collect()} == brute_variants(brute_words(rows))
    assert spelling.op11_spelling(spark, df.limit(0)).count() == 0


# Mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = [s for s in order if s not in full]
        if not left:
            return {s: 2.0 * sizes[s] for s in order}
        level = (1.5 * total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in left)
        more = {s for s in left if level * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


def check_mix(rows, got):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += count(r[4])
    want = brute_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], count(r[4])) for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s, target in want.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6


def test_mix(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("w" * rng.randint(1, 3) for _ in range(n))
    sources = [None, "", "a", "b", "Z", "é", "\U0001f600", "tiny"]
    rows = [(i, "b" if i % 3 else rng.choice(sources), "en", 1, prose(rng.randint(0, 40))) for i in range(600)]
    rows += [(700, "tiny", "en", 1, "one"), (701, "void", "en", 1, ""), (702, "void", None, None, None), (703, "a", "en", 1, " \x1fx\t\n")]
    same = prose(7)
    rows += [(None, "hot", "en", 1, same)] * 120 + [(5, "hot", "en", 1, same)] * 90 + [(None, "hot", "en", 1, prose(9)) for _ in range(30)]
    rows += [(900, "long", "en", 1, prose(60_000)), (901, "long", "en", 1, prose(50))]
    df = spark.createDataFrame(rows, DOCS).repartition(7).withColumns({"size": F.lit("clash"), "need": F.lit(1), "_bucket": F.lit(2)})
    got = mixing.mix(df)
    assert got.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "need", "_bucket",
                           "size", "source_size", "target", "copies"]
    check_mix(rows, got.collect())
    # Rows are taken by what they hold: another dealing gives the same answer.
    again = [tuple(r) for r in mixing.op12_mixing(spark, df.repartition(2, "text")).collect()]
    assert Counter(again) == Counter(tuple(r) for r in mixing.op12_mixing(spark, df).collect())
    assert mixing.op12_mixing(spark, df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "a", "en", 0, ""), (2, None, "en", 0, None)], DOCS)
    assert {tuple(r) for r in mixing.op12_mixing(spark, empty).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


@pytest.mark.parametrize("share,repeats", [(0, 2), (0.4, 1), (2, 2), (2.5, 3)])
def test_mix_shares(spark, share, repeats):
    docs = read(spark, SF, "documents")
    rows = mixing.mix(docs, columns=["source"], share=share, repeats=repeats).collect()
    total = sum(r.size for r in rows)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(share * total)
    assert all(0 <= r.copies <= repeats for r in rows)


# Merkle manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r, more=0):
        values = [r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        """Root, and per leaf its path."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                j = i ^ 1
                paths[k].append(("-" if j >= len(nodes) else "L" if j < i else "R", nodes[j] if j < len(nodes) else ""))
            nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            at = [i // 2 for i in at]
        return nodes[0], paths

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {g: sorted([r for r in rows if r[2] == g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in own[g]]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs])
    out = Counter()
    for g, top in zip(langs, tops, strict=True):
        for r, path in zip(own[g], trees[g][1], strict=True):
            path = path + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, 1 if bad else 0)
            for side, other in path:
                node = H(node) if side == "-" else H(other, node) if side == "L" else H(node, other)
            out[r[0], leaf(r), trees[g][0], root, H(*[o for _, o in path]), node, node == root] += 1
    return out


@pytest.mark.parametrize("levels", [merkle.LEVELS, 2])
def test_manifest_matches_brute_force(spark, levels):
    rng = random.Random(levels)
    ids = rng.sample(range(-500, 4000), 150) + [2**62, -(2**62), 2**63 - 1, -(2**63), 0, 63, 64, -1, -64]
    rows = [(i, rng.choice([None, "s", "é"]), rng.choice(["en", "en", "de", "fr"]), rng.choice([None, 5, 12]), rng.choice([None, "", "té:xt", "-"]))
            for i in ids]
    rows += [(7001, "s", None, 1, "null language"), (7002, "s", "", 1, "empty"), (7003, "s", "\U0001f600", 1, "x" * 300_000), (7004, "s", "￮", 2, "")]
    rows += [(None, "s", "en", 1, "no id")] * 5 + [(None, "s", "de", None, str(i)) for i in range(4)]
    rows += [(63, "s", "en", 3, "repeated")] * 70 + [(63, "t", "en", i, "repeated") for i in range(9)] + [(7003, "s", "de", 1, "")]
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({"leaf": F.lit("clash"), "group": F.lit(1), "row": F.lit(1)})
    assert Counter(tuple(r) for r in merkle.op13_merkle(spark, df, levels).collect()) == brute_manifest(rows)


def test_manifest_of_few_rows(spark):
    for rows in ([(1, "s", "en", 1, "alone")], [(7, None, None, None, None)], [(1, "s", "en", 1, "x"), (2, "s", "de", 1, "y")]):
        df = spark.createDataFrame(rows, DOCS)
        assert Counter(tuple(r) for r in merkle.op13_merkle(spark, df).collect()) == brute_manifest(rows)
    assert merkle.op13_merkle(spark, df.limit(0)).count() == 0


def test_paths_of_the_manifest_verify(spark):
    rows = merkle.manifest(read(spark, SF, "documents")).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        assert merkle.folded(bytes.fromhex(r.leaf), bytes(r.path)).hex() == r.root and r.verified
        assert merkle.folded(b"\0" * 32, bytes(r.path)).hex() != r.root
