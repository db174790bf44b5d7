import random
import time
from collections import Counter

from vigilspark.llm import htmltext


def text_of(source):
    return "\n\n".join(htmltext.main_blocks(htmltext.parse(source)))


def test_no_tag_becomes_text():
    for quote in "\"'":
        assert text_of(f"<p>One <img src={quote}data:{'x>' * 50_000}{quote}> end</p>") == "One end"
    assert text_of('<p>One <a href=x">two</a> three <a href="y">four</a></p>') == "One two three four"
    assert text_of("<p>One <a title='x>two</a> three</p>") == "One two three"
    assert text_of('<p>One <a title = "a>b" data-x=c"d checked>two</a></p>') == "One two"
    begun = time.time()
    text_of("<p>" + '<a href=x">y</a> ' * 20_000 + "<a b='>")
    assert time.time() - begun < 20


def test_copies_beside_other_articles_are_no_template(spark):
    page = "<body><div><p>Printed on every page of the host.</p><p>Another line of it.</p><article><p>{}</p><p>{}</p></article></div></body>"
    rows = [(i, f"http://h.org/{i}", page.format("The copied article.", "Its end.")) for i in range(95)]
    rows += [(100 + i, f"http://h.org/x{i}", page.format(f"Article {i}.", f"End {i}.")) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert {got[i] for i in range(95)} == {"The copied article.\n\nIts end."}
    assert [got[100 + i] for i in range(5)] == [f"Article {i}.\n\nEnd {i}." for i in range(5)]


def test_all_article_slots_are_kept():
    assert text_of("<div><section><p>One one.</p></section><section><p>Two.</p></section></div>") == "One one.\n\nTwo."
    assert text_of("<body><div><p>One one one.</p></div><div><p>Two.</p></div></body>") == "One one one.\n\nTwo."
    assert text_of("<main><article><p>Longer first.</p></article><article><p>Second.</p></article></main>") == "Longer first.\n\nSecond."
    assert text_of("<main>Lead.<article><p>Body text.</p></article><p>End.</p></main><div>Other</div>") == "Lead.\n\nBody text.\n\nEnd."
    for names in ("post category-social tag-comments", "post", "page-form type-ad"):
        assert text_of(f'<article class="{names}"><p>Text.</p></article>') == "Text."
    assert text_of('<article><p>Text.</p><article class="comment"><p>Nice!</p></article></article>') == "Text."
    assert text_of('<div class="post tag-menu"><p>Text of it.</p></div><div class="main-menu">m</div><div class="site-footer">f</div>') == "Text of it."
    assert text_of("<div><p>Prose with a <a>link</a> in it.</p></div>") == "Prose with a link in it."


def test_parse_takes_linear_time():
    for text in ("<a" * 500_000, "<!" * 500_000, "</script" * 100_000, "<script>" + "</script" * 100_000, "<div>x" * 100_000,
                 "<div>" * 100_000 + "</p>" * 100_000 + "end", "<p><a b='" * 100_000, "<" * 1_000_000, "<p>x" * 100_000):
        begun = time.time()
        text_of(text)
        assert time.time() - begun < 10, text[:20]
    assert text_of("<div>" * 100_000 + "deep") == "deep"


def brute_template(pages):
    """Tokens of the template, and all that is printed on every page, from the definition."""
    lists = [[htmltext.token(x) for x in htmltext.parse(p).items] for p in pages]
    counts = [Counter(x) for x in lists]
    vectors = {}
    for t in {t for c in counts for t in c}:
        if sum(t in c for c in counts) >= htmltext.FREQUENT * len(pages):
            vectors.setdefault(tuple(c[t] for c in counts), []).append(t)
    large = sorted(((sum(map(bool, v)), len(ts), ts) for v, ts in vectors.items() if len(ts) >= htmltext.LARGE), reverse=True)
    assert large[0][:2] != large[1][:2]
    valid = set()
    for k, (_, _, ts) in enumerate(large):
        ways = {t: set() for t in ts}
        for x in lists:
            edges = [x.index(t) for t in large[0][2] if t in x]
            for rank, i in enumerate(sorted(x.index(t) for t in ts if t in x)):
                ways[x[i]].add((rank, sum(e <= i for e in edges) if k else 0))
        alike = {t for t, w in ways.items() if len(w) == 1}
        if len(alike) >= htmltext.LARGE:
            valid |= alike
    return valid, {t for _, _, ts in large for t in ts}


def test_templates_match_brute_force(spark):
    rng = random.Random(3)
    pages = []
    for i in range(20):
        boxes = ["<div class='b1'><b>First box</b></div>", "<div class='b2'><b>Second box</b></div>"]
        order = boxes if i % 2 else boxes[::-1]  # printed on every page, but in no one order
        body = "".join(f"<p>Text {rng.random()}</p>" for _ in range(rng.randint(1, 4)))
        extra = "<div class='tip'><p>A tip on most pages.</p></div>" if i else ""
        pages.append(f"<body><div class='top'>Site</div>{''.join(order)}<div class='text'>{body}{extra}</div><div class='end'>End {i % 3}</div>"
                     "<ul><li>Last</li></ul></body>")
    valid, printed = brute_template(pages)
    rows = [("h", i, p) for i, p in enumerate(pages)]
    got = htmltext.templates(spark.createDataFrame(rows, "host string, page long, html string")).collect()
    unsigned = lambda xs: {x & (1 << 64) - 1 for x in xs}
    assert len(got) == 1 and unsigned(got[0].template) == valid and unsigned(got[0].printed) == printed
    assert valid < printed  # the boxes have no place of their own in the template
    template = htmltext.Template(frozenset(valid), frozenset(printed))
    page = htmltext.parse(pages[3])
    found = htmltext.main_blocks(page, template)
    assert found[-1] == "End 0" and len(found) > 1 and all(t.startswith("Text ") for t in found[:-1])
    filled = [[b.text for b in slot] for slot in htmltext.slots(page, template)]
    assert [slot for slot in filled if slot] == [[t] for t in found]  # paragraphs are a class of their own, printed repeatedly


def test_varying_boilerplate(spark):
    page = ("<body><div class='x1'><a href='/1'>Read {0} too</a> <a href='/2'>and {0}</a></div><div class='x2'><p>Prose number {0} of the "
            "page.</p></div><div class='x3'><p>Prose again {0}.</p></div><div class='x4'>The same below.</div></body>")
    rows = [(i, f"http://h.org/{i}", page.format(i * 31)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in htmltext.extract(df).collect()} == {
        i: f"Prose number {i * 31} of the page.\n\nProse again {i * 31}." for i in range(12)}
