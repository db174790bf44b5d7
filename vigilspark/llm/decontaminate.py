"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_columns

WORD = re.compile(r"\w+")
SEED_WORDS = 3
# A seed is rare if words drawn independently with the corpus's frequencies give it with at most this probability, which does
# not change with the size of the corpus. Copies of a passage make its words frequent, so every item keeps some seeds anyway.
RARE, LEAST_SEEDS = 1e-8, 8
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
MIN_ITEM_WORDS = 5
# Words of test items that are searched for in one pass over the documents; more items take more passes.
PASS_WORDS = 2_000_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

LEAK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(ids: np.ndarray) -> np.ndarray:
    """A hash of each run of ``SEED_WORDS`` word numbers."""
    n = len(ids) - SEED_WORDS + 1
    if n <= 0:
        return np.array([], np.uint64)
    ids = ids.astype(np.uint64)
    mixed = sum(ids[i : i + n] * _MIX[i] for i in range(SEED_WORDS))
    return mixed ^ (mixed >> np.uint64(29))


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its score as a share of a full match, and the first and last window word of it."""
    n = len(window)
    steps = np.arange(n) * -GAP
    row, began = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best, at, first = 0, 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(window == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        fresh = np.maximum(diagonal, above)
        start = np.where(diagonal >= above, began[:-1], began[1:])
        start = np.where(fresh > 0, start, np.arange(1, n + 1))
        fresh = np.maximum(fresh, 0)
        # Gaps along the row: the best earlier cell less its distance.
        lifted = fresh + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n), 0))
        fresh, start = top - steps, start[source]
        row, began = np.concatenate([[0], fresh]), np.concatenate([[0], start])
        peak = int(fresh.argmax())
        if fresh[peak] > best:
            best, at, first = int(fresh[peak]), peak, int(start[peak])
    return best / (MATCH * len(item)), first, at


class Seeds:
    """The rare n-grams of one set of test items, and where they stand in them."""

    def __init__(self, items: list[tuple[int | None, list[str]]], share: dict[str, float]):
        self.number = {w: n + 1 for n, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.names = [i for i, _ in items]
        self.items = [np.array([self.number[w] for w in ws], np.int64) for _, ws in items]
        found = []
        for k, (_, ws) in enumerate(items):
            logs = [math.log10(share.get(w, 0.0) or 1e-300) for w in ws]
            odds = [sum(logs[p : p + SEED_WORDS]) for p in range(len(ws) - SEED_WORDS + 1)]
            hashes = grams(self.items[k])
            # Whatever the corpus, an item has its rarest n-grams as seeds, so one of them outlives some edits.
            cut = max(math.log10(RARE), sorted(odds)[: LEAST_SEEDS][-1] if odds else 0.0)
            found += [(int(hashes[p]), k, p) for p, x in enumerate(odds) if x <= cut]
        found.sort()
        self.hashes = np.array([h for h, _, _ in found], np.uint64)
        self.item = np.array([k for _, k, _ in found], np.int64)
        self.place = np.array([p for _, _, p in found], np.int64)

    def leaks(self, text: str | None, min_score: float) -> list[dict]:
        """The items found in a text, each with its best alignment, in order of item number."""
        ids = np.array([self.number.get(w, 0) for w in words_of(text)], np.int64)
        hashes = grams(ids)
        if not len(hashes) or not len(self.hashes):
            return []
        low = np.searchsorted(self.hashes, hashes, "left")
        hit = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == hashes)
        hit = hit[(ids[hit] > 0) & (ids[hit + 1] > 0) & (ids[hit + 2] > 0)]
        if not len(hit):
            return []
        low = low[hit]
        many = np.searchsorted(self.hashes, hashes[hit], "right") - low
        each = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, diagonal = self.item[each], np.repeat(hit, many) - self.place[each]
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        length = np.array([len(x) for x in self.items])
        # Seeds of one item whose diagonals are nearer than the item is long share a window.
        cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(diagonal) > length[item[1:]])) + 1
        best: dict[int, tuple[float, int, int]] = {}
        for a, b in zip([0, *cuts], [*cuts, len(item)], strict=True):
            k = int(item[a])
            pad = len(self.items[k]) // 2 + 1
            start = max(0, int(diagonal[a]) - pad)
            window = ids[start : int(diagonal[b - 1]) + len(self.items[k]) + pad]
            score, first, last = align(self.items[k], window)
            if score >= min_score and score > best.get(k, (0.0,))[0]:
                best[k] = (score, start + first, start + last)
        return [{"item_id": self.names[k], "score": s, "first_word": a, "last_word": b}
                for k, (s, a, b) in sorted(best.items())]


def word_shares(docs: DataFrame, vocabulary: set[str], *, text: str = "text") -> dict[str, float]:
    """Shares of the given words among all words of all documents; one number per word comes to the driver."""
    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for body in b.column(0).to_pylist():
                words = words_of(body)
                seen[""] += len(words)
                seen.update([w for w in words if w in vocabulary])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "n"])

    counted = docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    got = {r.word: r.n for r in counted}
    total = max(1, got.pop("", 0))
    return {w: n / total for w, n in got.items()}


def annotate(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
             min_score: float = MIN_SCORE, pass_words: int = PASS_WORDS) -> DataFrame:
    """All columns of ``docs`` with ``leaks``: the test items that the document holds, whole or edited.

    A document is aligned with an item where they share a rare seed of three words; the alignment's score is divided by
    that of the full item. Null and empty texts hold nothing. Items with a null text or fewer than five words are not
    searched for, since chance alone gives such sequences. Repeated items and documents each count. Items are searched in
    as many passes as ``pass_words`` asks for, so what a task holds does not grow with the benchmark. A column called
    ``leaks`` is replaced.
    """
    usable = items.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    total = usable.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    passes = max(1, math.ceil(total / pass_words))
    out = docs.withColumn("leaks", F.array().cast(T.ArrayType(LEAK)))
    source = docs
    for k in range(passes):
        block = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect() if total else []
        texts = sorted(((r.item_id, words_of(r.text)) for r in block), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        texts = [x for x in texts if len(x[1]) >= MIN_ITEM_WORDS]
        if not texts:
            continue
        seeds = Seeds(texts, word_shares(source, {w for _, ws in texts for w in ws}, text=text))

        def make(seeds=seeds):
            def work(bodies):
                return [pa.array([seeds.leaks(t, min_score) for t in bodies],
                                 pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()),
                                                     ("first_word", pa.int64()), ("last_word", pa.int64())])))]
            return work

        found = with_columns(out, text, [T.StructField("leaks_here", T.ArrayType(LEAK))], make)
        out = found.withColumn("leaks", F.concat("leaks", "leaks_here")).drop("leaks_here")
    return out


def op10_decontaminate(spark, docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and test item found in it, with the alignment's score and place in words. Null and empty texts hold
    nothing, repeated rows and items each count, empty tables give no rows, and columns but the ids and texts are ignored."""
    found = annotate(docs.select("doc_id", "text"), items).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.*")
