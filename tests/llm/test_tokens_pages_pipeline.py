"""Tokenising, token files, main text and the pipeline."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vigilspark.llm import bpe, htmltext, queries, simhash, tokenfile
from vigilspark.llm.common import kept, read

SF = "/root/testdata/sf0.001"
ODD = ["", "  ", "a" * 2000, "<|endoftext|>hi<|startoftext|> there's it'll", "İstanbul ΣΑΣ σας ǅ ﬁ é 日本語 🙂 don't 12²¼",
       "\x1c\x85\xa0a​b", "hello,world!!!***", "é ñ", "x" * 70 + " " + "y" * 70, " lead  two\n\nlines \t"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("abcdethein ionrsSTx' 1é") for _ in range(rng.randint(1, 80))) for _ in range(1500)]


def test_bpe_equals_the_library(texts):
    mine, library = bpe.encoder(), Tokenizer.from_file(bpe.VOCABULARY)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.encode(text).tolist() == want.ids, text
        assert mine.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_query(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text").union(
        spark.createDataFrame([(-1, None), (-2, "a" * 50_000), (-3, "same"), (-3, "same")], "doc_id long, text string"))
    library = Tokenizer.from_file(bpe.VOCABULARY)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.op4_bpe(spark, docs.withColumn("ids", F.lit(1))).collect()]
    assert sorted(got) == sorted(want)
    assert bpe.op4_bpe(spark, docs.limit(0)).count() == 0


def test_piece_encoder_equals_the_library(texts):
    mine = tokenfile.PieceEncoder(tokenfile.VOCABULARY)
    for text, got in zip(texts, mine.encode(texts), strict=True):
        assert np.frombuffer(got, mine.kind).tolist() == mine.library.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark, tmp_path):
    docs = read(spark, SF, "documents").select("doc_id", "text").union(
        spark.createDataFrame([(-1, None), (-2, ""), (5_000, "a b " * 5000), (7, "again")], "doc_id long, text string"))
    folder = str(tmp_path / "tokens")
    manifest = tokenfile.write(docs, folder, length=64, shard_bytes=100_000)
    assert manifest.count() > 2
    got = sorted(tuple(r) for r in tokenfile.read(manifest, folder).collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted((r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in docs.collect())
    assert [(k, n, c) for k, _, n, c in got] == [(k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in rows] or \
        sorted((k, n, c) for k, _, n, c in got) == sorted((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in rows)
    starts = [s for _, s, _, _ in sorted(got, key=lambda r: r[1])]
    assert starts == np.cumsum([0, *[n for *_, n, _ in sorted(got, key=lambda r: r[1])]])[:-1].tolist()
    shard = tokenfile.Shard(folder, "shard-000000")
    batch = shard.file.get_batch(0)
    assert batch.column("ids").type.list_size == 64 and batch.column("mask").flatten().to_pylist()[0] is True
    # Every sequence and its mask: all of the shard's ids in order, and padding behind the last one alone.
    for row in manifest.collect():
        shard = tokenfile.Shard(folder, f"shard-{row.shard:06d}")
        ids, masks = zip(*(shard.sequence(i) for i in range(shard.sequences)), strict=True)
        assert {len(x) for x in ids} == {len(x) for x in masks} == {64}
        assert all(not x.flags.owndata for x in ids)
        mask = np.concatenate(masks)
        assert mask.tolist() == [i < row.ids for i in range(len(mask))] and len(mask) - row.ids < 64
        assert np.concatenate(ids)[mask].tolist() == shard.ids(0, row.ids).tolist() and not np.concatenate(ids)[~mask].any()
    empty = tokenfile.write(docs.limit(0), str(tmp_path / "none"))
    assert tokenfile.read(empty, str(tmp_path / "none")).count() == 0


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site name</header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies.</div><article><h1>Head &amp; more</h1>
<p><b>First   part<br>of it.<p>Second</p><div class="ad">Buy</div><form><p>Mail</p></form></article>
<section id="comments"><p>Nice!</p></section><aside>Side</aside><footer>&copy; me</footer>"""


def text_of(source):
    return "\n\n".join(htmltext.main_blocks(htmltext.parse(source)))


def test_main_text_of_one_page():
    assert text_of(PAGE) == "Head & more\n\nFirst part of it.\n\nSecond"
    assert text_of(None) == text_of("") == text_of("<p") == text_of("<nav>x") == ""
    assert text_of("just text") == "just text"
    assert text_of("<div><div><p>one one one</p><p>two</p></div></div><div class=menu>m</div>") == "one one one\n\ntwo"
    assert text_of("<div>" * 5000 + "deep") == "deep"


def test_template_text_is_no_content(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div><p>Printed on every page of this host, and rather a long line.</p><p>Text {i} of "
             f"the page.</p><p>More {i * 7}.</p></div></body>") for i in range(20)]
    rows += [(100, None, rows[0][2]), (101, "http://h.org/x", None), (102, "http://h.org/y", ""), (102, "http://h.org/y", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [(r.page_id, r.text, r.n_chars) for r in htmltext.extract(df).collect()]
    assert (3, "Text 3 of the page.\n\nMore 21.", 29) in got
    assert (101, "", 0) in got and got.count((102, "", 0)) == 2
    assert dict((k, t) for k, t, _ in got)[100].startswith("Printed")
    assert htmltext.extract(df.limit(0)).count() == 0


def test_copies_of_one_article_make_no_template(spark):
    rows = [(i, f"http://h.org/{i}", "<body><div><p>The same article everywhere.</p><p>Its end.</p></div></body>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in htmltext.extract(df).collect()} == {"The same article everywhere.\n\nIts end."}


def test_articles_of_the_tables(spark):
    def brute(source):
        inner = source[source.index("<article>") + 9 : source.rindex("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner))
        return "\n\n".join(x for x in parts if x)

    source = {r.page_id: r.html for r in read(spark, SF, "pages").collect()}
    for r in queries.op1_main_text(spark, SF).collect():
        assert r.text == brute(source[r.page_id]) and r.n_chars == len(r.text)


# Pipeline


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    extra = spark.createDataFrame(
        [(90_001, None, "en", "s", 0), (90_002, "12 34", "en", "s", 5), (90_003, "", None, None, 0),
         (None, "the same words in the text of the one that is the and", "en", "s", 1),
         (None, "the same words in the text of the one that is the and", "en", "s", 1)], docs.schema)
    now = kept(docs.union(extra), "pipeline-test")
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, kept(stage(spark, now, SF), name)
        counts[name] = now.count()
        if name == "language_id":
            assert {r.doc_id for r in now.collect()}.isdisjoint({90_001, 90_002, 90_003})
            assert counts[name] >= docs.count()
        if name == "simhash_near_dedup":
            rows = before.collect()
            prints = [simhash.fingerprint(r.text, corpus_pipeline.SHINGLE_WORDS) for r in rows]
            near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3
            left, groups = set(range(len(rows))), 0
            while left:
                groups, todo = groups + 1, [left.pop()]
                while todo:
                    x = todo.pop()
                    todo += (hit := [y for y in left if near(x, y)])
                    left -= set(hit)
            assert counts[name] == groups and sum(r.doc_id is None for r in now.collect()) == 1
        if name == "benchmark_decontamination":
            items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in read(spark, SF, "benchmark").collect()]
            dirty = {r.doc_id for r in before.collect() if any(
                f" {i} " in f" {' '.join(re.findall(r'\w+', r.text.lower()))} " for i in items)}
            assert dirty and not dirty & {r.doc_id for r in now.collect()}
        if name == "pii":
            assert counts[name] == before.count() and now.columns == docs.columns
            assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[a-z]", r.text) for r in now.collect())
    assert set(docs.columns) <= set(now.columns) and "n_tokens" in now.columns


CLASHES = ["_row", "_key", "key", "fp", "lang_pred", "score", "leaks", "leaks_here", "pii", "_pii_order", "ids", "decoded", "word",
           "component_id", "n_tokens"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_odd_rows_and_clashing_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = read(spark, SF, "documents").limit(40)
    long = " ".join(plain.first().text.split()[:200]) + " "
    odd = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "", "", 0), (9003, " \n", "en", "s", 2), (9004, long * 1500, "en", "s", 1),
         (9005, "write to a.b@example.org now " * 3000, "en", "s", 1), (9005, "write to a.b@example.org now " * 3000, "en", "s", 1),
         (None, "write to the other one of the two", "en", "s", 1), (9006, "x" * 200_000, "en", "s", 1)], plain.schema)
    docs = plain.union(odd)
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    docs = kept(docs, "clash")
    out = kept(stage(spark, docs, SF), f"clash-{name}")
    bare = kept(stage(spark, docs.select(*plain.columns), SF), f"bare-{name}")
    new = ["n_tokens", "ids_sha256", "ids"] if name == "bpe" else []
    assert set(docs.columns) | set(new) == set(out.columns)
    some = [c for c in plain.columns]
    assert sorted(map(str, out.select(*some).collect())) == sorted(map(str, bare.select(*some).collect()))
    for c in set(CLASHES) - set(new):
        assert {r[0] for r in out.select(f"`{c}`").distinct().collect()} == {f"own {c}"}
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    if name in ("pii", "bpe"):
        assert len(ids) == docs.count()
    if name == "simhash_near_dedup":
        assert ids.count(9005) == 1 and ids.count(9001) + ids.count(9002) + ids.count(9003) == 1
    if name == "benchmark_decontamination":
        assert set(ids) >= {9001, 9002, 9003, 9006, None}
    if name == "language_id":
        assert not {9001, 9002, 9003} & set(ids)
    if name == "pii":
        texts = {r.doc_id: r.text for r in out.collect()}
        assert texts[9001] is None and texts[9005] == "write to <EMAIL> now " * 3000


def test_pipeline_of_no_documents(spark):
    now = read(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        now = kept(stage(spark, now, SF), name)
    assert now.count() == 0
