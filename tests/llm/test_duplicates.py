"""SimHash, vectors and repeats against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vigilspark.llm import components, multiindex, repeats, simhash
from vigilspark.llm.common import read

SF = "/root/testdata/sf0.001"


def parts_of(n, pairs):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return [top(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(100)]
    pairs += [(600, 601 + i) for i in range(100)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = parts_of(800, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# SimHash


def brute_print(text, n=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", " \t\n", "One", "one two", "ÀB cD\x0bE f g h", "a b c d " * 50]:
        assert simhash.fingerprint(text, 3) == brute_print(text)


@pytest.mark.parametrize("budget", [1, 3])
def test_trie_links_connect_what_is_near(budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    keys = set(int(x) for x in base)
    for x in base[:20]:
        for _ in range(15):
            y = int(x)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(bit)
            keys.add(y)
    keys = np.array(sorted(keys), np.uint64)
    near = np.argwhere(np.bitwise_count(keys[:, None] ^ keys[None]) <= budget)
    assert simhash.trie_links(keys, budget).tolist() == parts_of(len(keys), near)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_near_groups(spark, bucket):
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(60)] + [0, 0]
    for x in prints[:30]:
        y = x
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                y ^= 1 << bit
            prints.append(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = [(None if i == 61 else 1000 - i, x) for i, x in enumerate(signed)]
    got = {(r.k, r.fp): r.component_id for r in simhash.near_groups(
        spark.createDataFrame(rows, "k long, fp long"), "k", bucket=bucket).collect()}
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    part = parts_of(len(prints), pairs)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[part[i]] = min(least.get(part[i], k), k)
    assert got == {rows[i]: least[part[i]] for i in range(len(rows))}


def test_simhash_query(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text").union(
        spark.createDataFrame([(9001, None), (9002, ""), (9003, " \n"), (9004, "One"), (9005, "oNE")], "doc_id long, text string"))
    rows = docs.collect()
    prints = [brute_print(r.text) for r in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    part = parts_of(len(rows), pairs)
    least = {}
    for i, r in enumerate(rows):
        least[part[i]] = min(least.get(part[i], r.doc_id), r.doc_id)
    want = {(r.doc_id, f"{prints[i]:016x}", least[part[i]]) for i, r in enumerate(rows)}
    assert {tuple(r) for r in simhash.op5_simhash(spark, docs.withColumn("fp", F.lit(1))).collect()} == want
    assert simhash.op5_simhash(spark, docs.limit(0)).count() == 0


# Vectors


def brute_vectors(rows):
    good = [i for i, (v, e, label) in enumerate(rows) if v is not None and label is not None and e
            and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    groups, links, pairs = {}, [0] * len(rows), []
    for i in good:
        groups.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    for g in groups.values():
        x = np.array([rows[i][1] for i in g], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(x @ x.T >= 0.98):
            if a != b:
                links[g[a]] += 1
                pairs.append((g[a], g[b]))
    part = parts_of(len(rows), pairs)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[part[i]] = min(least.get(part[i], r[0]), r[0])
    return sorted([(r[0], links[i], least.get(part[i]), r[0] == least.get(part[i])) for i, r in enumerate(rows)], key=str)


@pytest.mark.parametrize("blocks", [{}, {"residents": 10, "queries": 7}])
def test_vectors_match_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 6))
    rows = [(i, [float(x) for x in base[i % 30] + rng.standard_normal(6) * 0.06], i % 3 if i % 17 else None) for i in range(400)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 6, 1), (503, [float("nan")] * 6, 1), (504, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
             (505, rows[4][1], rows[4][2]), (506, rows[4][1], rows[4][2]), (507, [1.0, 2.0, 3.0], 1), (508, [2.0, 4.0, 6.0], 1),
             (509, [float("inf"), 1.0, 0.0], 1), (None, rows[4][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("clash"))
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = [tuple(r) for r in multiindex.near_vectors(df, **blocks).collect()]
    assert sorted(got, key=str) == brute_vectors(rows)
    assert multiindex.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_vectors_with_repeated_ids(spark, kind):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 4))
    rows = []
    for i in range(120):  # ids repeat within a label, across labels, and with equal and with other vectors
        v = base[i % 6] + rng.standard_normal(4) * (0.0 if i % 4 == 0 else 0.08)
        rows.append((i % 40, [float(x) for x in v], i % 3))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").withColumn(
        "label", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")) if kind == "date" else F.format_string("l %d", "n") if kind == "string"
        else F.col("n")).withColumn("label_id", F.lit("clash"))
    got = [tuple(r) for r in multiindex.near_vectors(df).collect()]
    assert sorted(got, key=str) == brute_vectors(rows)


def test_probes_reach_what_brute_force_over_all_cells_reaches():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = multiindex.fit(x, 6, 0.98)
    home, row, cell = grid.probes(x)
    assert home.tolist() == grid.cells(x).tolist()
    want = [[c for d, c in sorted((grid.distance(x[i : i + 1], np.array([c]))[0], c) for c in range(36)) if d <= grid.reach] for i in range(400)]
    assert all(sorted(cell[row == i].tolist()) == sorted(want[i]) and cell[row == i][0] == home[i] for i in range(400))


def test_vectors_of_the_tables(spark):
    df = read(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = [tuple(r) for r in multiindex.op8_vectors(spark, df).collect()]
    assert sorted(got, key=str) == brute_vectors(rows)


# Repeats


def brute_repeats(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = Counter()
    for (key, _), body in zip(rows, bodies, strict=True):
        covered = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            if seen[body[i : i + length]] > 1:
                covered[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        rest = bytes(x for x, c in zip(body, covered, strict=True) if not c)
        out[key, len(body), int(covered.sum()), runs, hashlib.sha256(rest).hexdigest()] += 1
    return out


def test_repeats_match_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(60) for _ in range(5)]
    rows = [(i, prose(rng.randint(5, 200))) for i in range(60)]
    rows += [(i, prose(rng.randint(0, 30)) + rng.choice(passages)[rng.randint(0, 20) :] + prose(rng.randint(0, 20)))
             for i in range(60, 140)]
    rows += [(200, None), (201, ""), (202, "ab " * 500), (203, "ab " * 300 + "x"), (204, "a" * 1000), (205, rows[3][1]),
             (205, rows[3][1]), (None, rows[4][1] + "q"), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).withColumn("key", F.lit("clash"))
    for options in ({}, {"batches": 3, "scan_rows": 50, "compare_rows": 20, "hot_suffix": 5}):
        got = Counter(tuple(r) for r in repeats.remove_repeats(df, **options).drop("kept").collect())
        assert got == brute_repeats(rows, 200)
    assert repeats.op9_repeats(spark, df.limit(0)).count() == 0


def test_repeats_of_texts_longer_than_a_chunk(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcd ") for _ in range(3000)).encode()
    whole = [repeats.stretches(np.frombuffer(text, np.uint8), np.array([len(text)]), 200)]
    monkeypatch.setattr(repeats, "CHUNK", 700)
    covered = []
    for group in repeats._pieces([text], 200):
        for _, at, part in group:
            _, first, last = repeats.stretches(np.frombuffer(part, np.uint8), np.array([len(part)]), 200)
            covered += [w + at for a, b in zip(first, last, strict=True) for w in range(a, b + 1)]
    assert covered == list(range(len(text) - 199)) == [w for a, b in zip(*whole[0][1:], strict=True) for w in range(a, b + 1)]
