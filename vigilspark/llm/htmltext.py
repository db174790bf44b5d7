"""Main text of web pages, by the templates that pages of one host share.

Pages are token streams in the order of the page: tags with their path, and blocks of text with theirs. Tokens of a host with
the same occurrence vector over its pages (how often on each page) form an equivalence class. Large, frequent classes are what
the host's program prints on every page, and their text is no content. The tokens of a class that come in one order on all
pages, and in the same gap between two tokens of the host's outermost class (the largest of those on most pages), are valid:
they nest, and make up the template. What a page has between two neighbouring tokens of its template fills a slot; slots of
article text make up the main text.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept

# A class is frequent if its tokens are on this share of a host's pages, and large if it has so many tokens; hosts with
# fewer articles have no template, for there everything would look like one. Pages with equal articles are copies and
# count as one page.
FREQUENT, LARGE, FEWEST_TEXTS = 0.9, 2, 4

# A quote opens a value only after an equals sign; one that is never closed ends like an unquoted value, so that the tag
# ends at the next '>'.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                 r"((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>|<[!?][^>]*>", re.S)
# A tag that the end of the page cuts off.
CUT_OFF = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
RAW = frozenset(["script", "style", "noscript", "textarea", "template", "iframe", "svg", "math", "object", "title", "select"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
BLOCK = frozenset([
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"])
SPACED = frozenset(["br", "td", "th", "option"])
# What encloses no main text, by element and by words of class, id or role. Names that begin like those by which themes file
# an article under its subjects say nothing of its place; an article's own names count as a whole only.
OUTSIDE = frozenset(["aside", "button", "dialog", "footer", "form", "head", "menu", "nav"])
OUTSIDE_WORDS = frozenset([
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "gdpr", "login", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "replies",
    "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "widget"])
FILED = re.compile(r"(?:category|cat|tag|tags|topic|post|page|type|format|status|author|term|taxonomy)-")
# A slot of a page without an article element is no article text if more than this share of it is links.
LINKS = 0.5
# Hosts whose templates a task keeps at once.
KNOWN_HOSTS = 200
OPEN_ENDED = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
              "tr": frozenset(["tr"])}


@dataclass
class Block:
    path: str
    text: str
    outside: bool
    article: int  # number of the innermost article or main element, or -1
    linked: int  # characters inside links


@dataclass
class Page:
    items: list[str | Block] = field(default_factory=list)  # tags, opened or closed, and blocks, as they come

    @property
    def blocks(self) -> list[Block]:
        return [x for x in self.items if isinstance(x, Block)]


def _outside(name: str, attributes: str, in_article: bool) -> bool:
    if name in OUTSIDE or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        for given in (a or b or c).lower().split():
            if FILED.match(given):
                continue
            if given in OUTSIDE_WORDS or (name != "article" and not OUTSIDE_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", given))):
                return True
    return False


def parse(source: str | None) -> Page:
    """Tags with their paths, and text blocks. Unclosed, misplaced and cut-off markup is taken as it comes. The time is linear
    in the length of the page, whatever it holds."""
    page = Page()
    if not source:
        return page
    # Open block elements: name, path, outside, article; and how many of each name are open.
    stack: list[tuple[str, str, bool, int]] = [("", "", False, -1)]
    opened: Counter = Counter()
    waiting: list[str] = []
    articles = linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if waiting:
            text = " ".join(html.unescape("".join(waiting)).split())
            waiting.clear()
            if text:
                _, path, outside, article = stack[-1]
                page.items.append(Block(path, text, outside, article, linked))
        linked = 0

    def write(text: str) -> None:
        nonlocal linked
        waiting.append(text)
        if in_link:
            linked += len(text.strip())

    def leave(k: int) -> None:
        for name, *_ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    at, size, last = 0, len(source), source.rfind(">")
    while at < size:
        # Behind the last '>' no tag can end, and looking for one from every '<' would take its square.
        found = TAG.search(source, at) if at <= last else None
        if not found:
            write(CUT_OFF.sub("", source[at:]) if "<" in source[at:] else source[at:])
            break
        if found.start() > at:
            write(source[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing, attributes = found[1] == "/", found[3]
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(f"</{name}\\b[^>]*>", re.I).search(source, at) if at <= last else None
                at = end.end() if end else size
            continue
        if name in SPACED:
            waiting.append(" ")
        if name == "a":
            in_link = not closing
        if name not in BLOCK and name not in OUTSIDE:
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            if opened[name]:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name)
                page.items.append("/" + stack[k][1])
                leave(k)
            continue
        ends = OPEN_ENDED.get(name)
        if ends and stack[-1][0] in ends:
            leave(len(stack) - 1)
        _, path, outside, article = stack[-1]
        if name in ("article", "main") and not outside:
            article = articles
            articles += 1
        kind = name if name in ("p", "li", "tr") else name + "".join(
            f".{(a or b or c).lower()}" for _, a, b, c in ATTRIBUTE.findall(attributes)) if attributes else name
        path = f"{path}>{kind}"
        if len(stack) > 200:  # markup that never closes anything
            path = path[-400:]
        stack.append((name, path, outside or _outside(name, attributes, article >= 0), article))
        opened[name] += 1
        page.items.append(path)
    flush()
    return page


def token(item: str | Block) -> int:
    """Number of a tag by its path, or of a text block by path and text."""
    text = f"{item.path}\0{item.text}" if isinstance(item, Block) else item
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


@dataclass(frozen=True)
class Template:
    """Tokens of a host's template, and all tokens that it prints on every page, in whatever order."""

    tokens: frozenset[int] = frozenset()
    printed: frozenset[int] = frozenset()


def slots(page: Page, template: Template) -> list[list[Block]]:
    """The blocks between neighbouring tokens of the template, slot by slot; blocks that the host prints on every page are in
    none."""
    out: list[list[Block]] = [[]]
    for item in page.items:
        number = token(item)
        if number in template.tokens:
            if out[-1]:
                out.append([])
        elif isinstance(item, Block) and number not in template.printed:
            out[-1].append(item)
    return out


def main_blocks(page: Page, template: Template = Template()) -> list[str]:
    """The text of all slots that carry article text, in the order of the page.

    In a page with article or main elements that are those within any of them; in others, all but menus, notices and the like
    and slots of links. A page of nothing but links keeps them.
    """
    filled = [[b for b in slot if not b.outside] for slot in slots(page, template)]
    if any(b.article >= 0 for slot in filled for b in slot):
        return [b.text for slot in filled for b in slot if b.article >= 0]
    prose = [slot for slot in filled if sum(b.linked for b in slot) <= LINKS * sum(len(b.text) for b in slot)]
    if not any(prose):
        prose = filled
    return [b.text for slot in prose for b in slot]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: a hash of its article, and its tokens in order of their first place, with their numbers."""
    for b in batches:
        hosts, pages, articles, lists, numbers = [], [], [], [], []
        for host, key, source in zip(*(b.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
            page = parse(source)
            seen = Counter(map(token, page.items))
            if not seen:  # null and empty pages say nothing about a template
                continue
            blocks = page.blocks
            article = " ".join([x.text for x in blocks if x.article >= 0] or [x.text for x in blocks if not x.outside])
            hosts.append(host)
            pages.append(key)
            articles.append(_signed(xxhash.xxh3_64_intdigest(article.encode("utf-8", "replace"))))
            lists.append([_signed(t) for t in seen])
            numbers.append(list(seen.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(articles, pa.int64()),
             pa.array(lists, pa.list_(pa.int64())), pa.array(numbers, pa.list_(pa.int32()))],
            names=["host", "page", "article", "tokens", "numbers"])


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages and a fingerprint of the occurrence vector, combined before the shuffle."""
    held: dict[tuple[str, int], list[int]] = {}

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in held], pa.string()), pa.array([t for _, t in held], pa.int64()),
             pa.array([x[0] for x in held.values()], pa.int64()), pa.array([_signed(x[1]) for x in held.values()], pa.int64())],
            names=["host", "token", "pages", "vector"])
        held.clear()
        return made

    for b in batches:
        for host, key, seen, numbers in zip(*(b.column(c).to_pylist() for c in ("host", "article", "tokens", "numbers")),
                                            strict=True):
            for token, n in [(0, 1), *zip(seen, numbers, strict=True)]:
                x = held.setdefault((host, token), [0, 0])
                x[0] += 1
                x[1] ^= xxhash.xxh3_64_intdigest(f"{key}:{n}")
            if len(held) > 200_000:
                yield out()
    if held:
        yield out()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def arranged(tokens: list[int], classes: list[list[int]]) -> list[tuple[int, int]]:
    """The tokens of a page's classes, each with how it lies: its rank in its class and, for all but the first class, the gap
    between tokens of the first one. ``tokens`` are in order of their first place on the page."""
    place = {t: i for i, t in enumerate(tokens)}
    out, edges = [], []
    for k, members in enumerate(classes):
        at = sorted((place[t], t) for t in members if t in place)
        if k == 0:
            edges = [x for x, _ in at]
        out += [(t, rank << 32 | (bisect(edges, x) if k else 0)) for rank, (x, t) in enumerate(at)]
    return out


def _arrangements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and greatest arrangement of each host's tokens over the pages of a task, before any shuffle."""
    held: dict[tuple[str, int], list[int]] = {}

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in held], pa.string()), pa.array([t for _, t in held], pa.int64()),
             *[pa.array([x[i] for x in held.values()], pa.int64()) for i in (0, 1)]],
            names=["host", "token", "least", "greatest"])
        held.clear()
        return made

    known: dict[str, list[list[int]]] = {}
    for b in batches:
        every = b.column("classes")
        for i, (host, seen) in enumerate(zip(b.column("host").to_pylist(), b.column("tokens").to_pylist(), strict=True)):
            if host not in known:  # a host's classes stand in each of its rows
                if len(known) >= KNOWN_HOSTS:
                    known.clear()
                known[host] = every[i].as_py()
            for number, lies in arranged(seen, known[host]):
                x = held.setdefault((host, number), [lies, lies])
                x[0], x[1] = min(x[0], lies), max(x[1], lies)
        if len(held) > 200_000:
            yield out()
    if held:
        yield out()


def templates(pages: DataFrame) -> DataFrame:
    """``host``, the tokens of its ``template`` and all that it has ``printed`` on every page. ``pages`` has host, page, html."""
    parsed = kept(pages.where("host IS NOT NULL").mapInArrow(
        _tokens, "host string, page long, article long, tokens array<long>, numbers array<int>"), "page-tokens")
    # Of the pages with one article, the one of the least key stands for all.
    first = parsed.groupBy("host", "article").agg(F.min("page").alias("page"))
    single = parsed.join(first, ["host", "article", "page"], "left_semi").dropDuplicates(["host", "article", "page"])
    counted = single.select("host", "article", "tokens", "numbers").mapInArrow(
        _statistics, "host string, token long, pages long, vector long")
    summed = kept(counted.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector")),
                  "page-statistics")
    # Token 0 is every page's.
    hosts = summed.where("token = 0").select("host", F.col("pages").alias("all")).where(F.col("all") >= FEWEST_TEXTS)
    frequent = summed.where("token <> 0").join(hosts, "host").where(F.col("pages") >= F.col("all") * FREQUENT)
    classes = frequent.groupBy("host", "vector").agg(F.collect_set("token").alias("tokens"), F.max("pages").alias("pages"))
    # The outermost class comes first: that on most pages, of these the largest.
    order = F.struct((-F.col("pages")).alias("pages"), (-F.size("tokens")).alias("size"), "vector", "tokens")
    listed = classes.where(F.size("tokens") >= LARGE).groupBy("host").agg(F.array_sort(F.collect_list(order)).alias("classes"))
    listed = kept(listed.select("host", F.col("classes.tokens").alias("classes")), "page-classes")
    lying = parsed.select("host", "tokens").join(listed, "host").mapInArrow(
        _arrangements, "host string, token long, least long, greatest long")
    alike = lying.groupBy("host", "token").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).where(
        "least = greatest").groupBy("host").agg(F.collect_set("token").alias("alike"))
    # A class of which fewer tokens than a large one has keep their places is left out.
    kept_tokens = F.transform("classes", lambda tokens: F.array_intersect(tokens, "alike"))
    valid = F.flatten(F.filter(kept_tokens, lambda tokens: F.size(tokens) >= LARGE))
    return listed.join(alike, "host", "left").select(
        "host", F.coalesce(valid, F.array().cast("array<long>")).alias("template"), F.flatten("classes").alias("printed"))


def _pieces(column: pa.ListArray) -> Iterator[bytes]:
    """The lists of numbers of a column, each as bytes; null is empty. Most rows repeat one of a few lists."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield values[ends[i] : ends[i + 1]].tobytes() if valid else b""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[bytes, bytes], Template] = {}
    for b in batches:
        texts = []
        lists = [_pieces(b.column(c)) for c in ("_template", "_printed")]
        for source, *shape in zip(b.column("_html").to_pylist(), *lists, strict=True):
            shape = tuple(shape)
            if shape not in known:
                if len(known) >= KNOWN_HOSTS:
                    known.clear()
                known[shape] = Template(*(frozenset(np.frombuffer(x, np.uint64).tolist()) for x in shape))
            texts.append("\n\n".join(main_blocks(parse(source), known[shape])))
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["_row", "text", "n_chars"])


def extract(pages: DataFrame, *, url: str = "url", source: str = "html") -> DataFrame:
    """All columns of ``pages`` with ``text`` and ``n_chars`` (code points).

    Null and empty pages give an empty text. Pages without a host are read without a template. Repeated pages are separate
    rows with equal results. Columns called ``text`` or ``n_chars`` are replaced.
    """
    # The user name and port are not part of a host's name.
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.struct(*pages.columns).alias("_row"), F.col(source).alias("_html"),
                        F.when(host != "", host).alias("_host"))
    stats = rows.select(F.col("_host").alias("host"), F.xxhash64("_host", "_row").alias("page"), F.col("_html").alias("html"))
    made = kept(templates(stats), "page-templates").select(
        F.col("host").alias("_host"), F.col("template").alias("_template"), F.col("printed").alias("_printed"))
    joined = rows.join(made, "_host", "left").select("_row", "_html", "_template", "_printed")
    schema = T.StructType([joined.schema["_row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    done = joined.mapInArrow(_extracted, schema)
    rest = [F.col(f"_row.`{c}`") for c in pages.columns if c not in ("text", "n_chars")]
    return done.select(*rest, "text", "n_chars")


def op1_main_text(spark, pages: DataFrame) -> DataFrame:
    """Main text of all pages: null and empty pages have an empty text, and columns but page_id, url and html are ignored."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
