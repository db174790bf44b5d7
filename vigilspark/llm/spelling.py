"""Spelling variants: words one edit apart, found by neighbourhoods of words over a reduced alphabet.

Every letter is hashed to one of a few symbols, so a word becomes a reduced word with few neighbours: all strings over the
symbols that are one edit away. Words within one edit have reduced words that are equal or within one edit, so joining the
neighbourhoods with the reduced vocabulary meets every such pair; each pair is then verified on the original words.

A pair is generated from one side only: by the deletion in the longer word, or the replacement in the word with the smaller
symbol. A neighbour carries the place of its edit, and so which end of the original word the edit leaves alone; the three
letters there are part of the join's key, which keeps apart the many words that share a short reduced word.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
MIN_LENGTH, MIN_COUNT, DOMINANCE = 7, 2, 10
# Of the runs of letters of a document, one in so many loses a letter.
LOSSY = 31
SYMBOLS = 4
# Letters at the end of a word that an edit elsewhere leaves alone.
END = 3
# Distinct words that one task counts before it hands them on, and characters of a text that are searched at once.
COUNTED, CHARS = 200_000, 1 << 20
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def _runs(text: str, pattern: re.Pattern) -> Counter:
    """The text's runs of letters, lower-cased in A-Z, with their numbers."""
    found = Counter(pattern.findall(text) if len(text) <= CHARS else (m[0] for m in pattern.finditer(text)))
    out = Counter()
    for run, n in found.items():
        out[run if run.islower() else run.translate(_LOWER)] += n
    return out


def _counted(min_length: int, lossy: int):
    pattern = re.compile(rf"[A-Za-zÀ-ÿ]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in _runs(text, pattern).items():
                    h = zlib.crc32(word.encode(), begun)
                    if lossy and h % lossy == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    words[word] += n
                if len(words) >= COUNTED:
                    yield rows()
                    words.clear()
        if words:
            yield rows()

    return run


def vocabulary(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, lossy: int = 0) -> DataFrame:
    """``word`` and ``n`` of all runs of letters of at least ``min_length`` code points that occur ``min_count`` times.

    With ``lossy`` the runs whose crc32 (of key, colon and run) it divides lose the letter that the crc32 names; a null key
    counts as empty text there. Null and empty texts have no words. Every task counts its own rows first, so a word of much
    of the corpus is few rows of the shuffle.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_counted(min_length, lossy), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """The word with every letter hashed to one of the symbols 0, 1, 2, ...; other characters count as 0."""
    to = "".join(str(ord(c) * 2654435761 % (1 << 32) * symbols >> 32) for c in LETTERS)
    return F.regexp_replace(F.translate(word, LETTERS, to), rf"[^0-{symbols - 1}]", "0")


def _end(side: Column, word: str) -> Column:
    return F.when(side == "P", F.substring(word, 1, END)).otherwise(F.right(F.col(word), F.lit(END)))


def _key(form: Column, side: Column, word: str) -> Column:
    return F.xxhash64(form, side, _end(side, word)).alias("key")


def _neighbours(words: DataFrame, symbols: int, min_length: int) -> DataFrame:
    """One row per word and member of its neighbourhood: the join's key, ``op`` and the place ``at`` of the edit, from 1."""
    def part(i: Column, inner: Column) -> Column:
        before = F.substr("_form", F.lit(1), i - 1)
        return F.concat(before, inner, F.substr("_form", i + 1))

    def one(op: str, i: Column, form: Column, side: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), i.cast("int").alias("at"), side.alias("side"), form.alias("form"))

    def side(i: Column) -> Column:
        return F.when(i > END, "P").otherwise("S")

    places = F.sequence(F.lit(1), F.length("word"))
    zero = F.lit(0)
    same = F.array(*[one("=", zero, F.col("_form"), F.lit(s)) for s in "PS"])
    fewer = F.when(F.length("word") > min_length, F.transform(places, lambda i: one("-", i, part(i, F.lit("")), side(i))))
    other = F.flatten(F.transform(places, lambda i: F.transform(
        F.filter(F.array(*[F.lit(str(s)) for s in range(symbols)]), lambda s: s > F.substr("_form", i, F.lit(1))),
        lambda s: one("r", i, part(i, s), side(i)))))
    near = F.explode(F.concat(same, F.coalesce(fewer, F.array().cast("array<struct<op:string,at:int,side:string,form:string>>")), other))
    cut = words.withColumn("_form", reduced(F.col("word"), symbols)).select("word", "n", near.alias("e"))
    return cut.select(_key(F.col("e.form"), F.col("e.side"), "word"), F.col("word").alias("a"), F.col("n").alias("n_a"),
                      F.col("e.op").alias("op"), F.col("e.at").cast("short").alias("at"))


def near_pairs(words: DataFrame, *, symbols: int = SYMBOLS, min_length: int = MIN_LENGTH) -> DataFrame:
    """Each unordered pair ``a``, ``b`` of the distinct words exactly one edit apart, once, with ``n_a`` and ``n_b``.

    Words must have at least ``min_length`` code points, more than twice ``END``. The condition of the join verifies on the
    original words; of several places that give the same word by a deletion the first counts, and a replacement by a letter
    of the same symbol, whose place the reduced words do not tell, is verified by edit distance.
    """
    if min_length <= 2 * END or not 2 <= symbols <= 10:
        raise ValueError("words must be longer than both ends together, and symbols between 2 and 10")
    sides = F.explode(F.array(F.lit("P"), F.lit("S")))
    held = words.select("word", "n", sides.alias("side")).select(
        _key(reduced(F.col("word"), symbols), F.col("side"), "word"), F.col("word").alias("b"), F.col("n").alias("n_b"),
        (F.col("side") == "P").alias("first"))
    a, b, at = F.col("a"), F.col("b"), F.col("at").cast("int")

    def but(word: Column) -> Column:
        return F.concat(F.substr(word, F.lit(1), at - 1), F.substr(word, at + 1))

    one = F.lit(1)
    fewer = (b == but(a)) & (F.substr(a, at, one) != F.substr(b, at, one))
    other = (F.length(a) == F.length(b)) & (but(a) == but(b))
    same_start = F.substring("a", 1, END) == F.substring("b", 1, END)
    same = (a < b) & (F.col("first") == same_start) & (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 1) == 1)
    right = F.when(F.col("op") == "-", fewer).when(F.col("op") == "r", other).otherwise(same)
    entries = _neighbours(words, symbols, min_length)
    return entries.join(held, (entries["key"] == held["key"]) & right).select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame, most: int, dominance: int) -> DataFrame:
    """``word`` and ``root`` for every word with a form. A form is at least ``dominance`` times as frequent as its word, so
    chains are short, and each round doubles the steps that have been followed."""
    longest = max(1, math.ceil(math.log(max(2, most), dominance)))
    roots = kept(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log2(longest))):
        further = roots.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        joined = roots.join(further, F.col("root") == F.col("_at"), "left")
        roots = kept(joined.select("word", F.coalesce("_to", "root").alias("root")), "spelling-roots")
    return roots


def variants(words: DataFrame, *, dominance: int = DOMINANCE, symbols: int = SYMBOLS, min_length: int = MIN_LENGTH) -> DataFrame:
    """For every distinct ``word`` with its number ``n``: ``form``, ``root``, ``n_near`` and ``form_n``.

    The form is the near word of largest n (ties: the smallest in code-point order) if that is at least ``dominance`` times
    the word's own; the root is where following forms ends. Words that nothing is near have themselves as root. ``words`` is
    read several times, so it should be stored. All keys are words or hashes of neighbours, which repeat no more than there
    are distinct words; hot ones are split by adaptive execution.
    """
    if dominance < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    pairs = near_pairs(words, symbols=symbols, min_length=min_length)
    directed = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))).alias("p")).select("p.*")
    best = directed.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("best"))
    known = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                    F.col("best.other").alias("other"), (-F.col("best.less")).alias("m"))
    clear = F.col("m") >= dominance * F.col("n")
    known = kept(known.select("word", "n", "n_near", F.when(clear, F.col("other")).alias("form"),
                              F.when(clear, F.col("m")).alias("form_n")), "spelling-forms")
    most = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.where("form IS NOT NULL"), most, dominance)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (columns doc_id, text; others are ignored) with their forms and roots.

    Null and empty texts have no words, repeated rows count repeatedly, and an empty table gives no rows.
    """
    words = kept(vocabulary(docs.select("doc_id", "text"), lossy=LOSSY), "spelling-words")
    return variants(words)
