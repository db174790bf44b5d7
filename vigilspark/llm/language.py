"""Language identification by unigram models over a fixed piece vocabulary, summed over all segmentations."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHE_ENTRIES, fold, groups, hold, kept, with_columns

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# Probability of a character that no piece of the vocabulary covers, the same in every language.
UNSEEN = 1e-9
SMOOTHING = 0.05
SMALL, LARGE = 1e-150, 1e150


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The lower-case letter pieces of the vocabulary; ``▁`` marks a word's start."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p.lower() == p and all(c == "▁" or c.isalpha() for c in p)})


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters. No piece crosses a word's start, so a text's sum is the product of its words' sums."""
    return LETTERS.findall(text.lower()) if text else []


def forward(words: list[str], table: dict, langs: int, longest: int) -> Iterator[tuple[str, list[float]]]:
    """Per word, and per language, the log of the summed probability of all segmentations of ``▁word``.

    The words are taken in order, since the sums up to a common beginning serve all words that share it. Sums are lifted
    when they become tiny; ``lifts`` counts how often along the present word.
    """
    every = range(langs)
    known = table.get
    before_word, rows, lifts = "", [[1.0] * langs], [0]
    for word in sorted(words):
        marked = "▁" + word
        same = 0
        for x, y in zip(marked, before_word, strict=False):
            if x != y:
                break
            same += 1
        if lifts[-1]:  # lifted rows are changed in place, so they serve no other word
            same = 0
        del rows[same + 1 :], lifts[same + 1 :]
        before_word = marked
        for end in range(same + 1, len(marked) + 1):
            row = [0.0] * langs
            for start in range(max(0, end - longest), end):
                p = known(marked[start:end])
                if p is not None:
                    before = rows[start]
                    for k in every:
                        row[k] += before[k] * p[k]
            if marked[end - 1] not in table:
                before = rows[end - 1]
                for k in every:
                    row[k] += before[k] * UNSEEN
            rows.append(row)
            lifts.append(lifts[-1])
            if max(row) < SMALL:
                lifts[-1] += 1
                for old in rows[-longest:]:
                    for k in every:
                        old[k] *= LARGE
        yield word, [math.log(max(x, 1e-300)) - lifts[-1] * math.log(LARGE) for x in rows[-1]]
        if lifts[-1]:
            before_word, rows, lifts = "", [[1.0] * langs], [0]


def expected_pieces(word: str, table: dict, longest: int) -> dict[str, float]:
    """Expected count of each piece over all segmentations of ``▁word`` under one language's probabilities."""
    word = "▁" + word
    n = len(word)
    ahead, behind, used = [1.0] + [0.0] * n, [0.0] * n + [1.0], []
    for end in range(1, n + 1):
        for start in range(max(0, end - longest), end):
            p = table.get(word[start:end])
            if p is not None:
                ahead[end] += ahead[start] * p
                used.append((start, end, p))
        if word[end - 1] not in table:
            ahead[end] += ahead[end - 1] * UNSEEN
            used.append((end - 1, end, UNSEEN))
    counts: dict[str, float] = {}
    if ahead[n] < SMALL:  # a long word: the same in logarithms, since its probability is too small a number
        logs, back = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for start, end, p in used:
            logs[end] = _log_sum(logs[end], logs[start] + math.log(max(p, 1e-300)))
        for start, end, p in reversed(used):
            back[start] = _log_sum(back[start], back[end] + math.log(max(p, 1e-300)))
        for start, end, p in used:
            share = math.exp(logs[start] + math.log(max(p, 1e-300)) + back[end] - logs[n])
            counts[word[start:end]] = counts.get(word[start:end], 0.0) + share
        return counts
    for start, end, p in reversed(used):
        behind[start] += p * behind[end]
    for start, end, p in used:
        counts[word[start:end]] = counts.get(word[start:end], 0.0) + ahead[start] * p * behind[end] / ahead[n]
    return counts


def _log_sum(a: float, b: float) -> float:
    high, low = max(a, b), min(a, b)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


@dataclass
class Model:
    """Languages in order of name and, per piece, one probability per language. ``mark`` names the model in caches."""

    langs: list[str]
    table: dict[str, tuple[float, ...]]
    mark: str


class Sums:
    """Sums of words already seen by this Python worker: their places, and a row of numbers each."""

    def __init__(self, langs: int):
        self.place: dict[str, int] = {}
        self.rows = np.empty((1024, langs))

    def add(self, words: Iterator[tuple[str, list[float]]]) -> None:
        for word, sums in words:
            at = len(self.place)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            self.rows[at] = sums
            self.place[word] = at

    def of(self, counts: Counter) -> np.ndarray:
        """The sums of a text, given its words."""
        at = np.fromiter(map(self.place.__getitem__, counts), np.int64, len(counts))
        return np.fromiter(counts.values(), np.float64, len(counts)) @ self.rows[at]


# For the model that this Python worker last used.
_CACHE: dict[str, Sums] = {}


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 500,
        rounds: int = 2, vocabulary: str = VOCABULARY) -> Model:
    """A model by expectation maximisation.

    About ``per_language`` documents of each language are read, drawn by a hash of their keys. Rows with null text or
    language are left out, as are null keys. What comes to the driver is one number per piece of the vocabulary and language.
    """
    pieces = load_pieces(vocabulary)
    longest = max(map(len, pieces))
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # The model holds every language on the driver, so their counts fit there, too.
    shares = {r.lang: per_language / r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if shares:
        share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
        rows = rows.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches):
        seen: dict[str, Counter] = {}
        for b in batches:
            for name, body in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                seen.setdefault(name, Counter()).update(words_of(body))
        for name, found in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(list(found), pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    counted = rows.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    counted = kept(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    langs = sorted(r.lang for r in counted.select("lang").distinct().collect())
    tables = {name: dict.fromkeys(pieces, 1.0 / len(pieces)) for name in langs}

    for _ in range(rounds if langs else 0):
        def share(batches, tables=tables):
            sums: dict[str, dict[str, float]] = {}
            for b in batches:
                for name, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                    own = sums.setdefault(name, {})
                    for piece, x in expected_pieces(word, tables[name], longest).items():
                        own[piece] = own.get(piece, 0.0) + n * x
            for name, own in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(own), pa.string()), pa.array(list(own), pa.string()),
                     pa.array(list(own.values()), pa.float64())], names=["lang", "piece", "n"])

        parts = counted.mapInArrow(share, "lang string, piece string, n double")
        got = parts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        fresh = {name: dict.fromkeys(pieces, SMOOTHING) for name in langs}
        for r in got:
            if r.piece in fresh[r.lang]:
                fresh[r.lang][r.piece] += r.n
        for name, own in fresh.items():
            total = sum(own.values())
            tables[name] = {p: x / total for p, x in own.items()}
    return Model(langs, {p: tuple(tables[name][p] for name in langs) for p in pieces}, uuid.uuid4().hex)


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``lang_pred`` and ``score``, the posterior of that language under equal priors.

    Null texts, texts without a letter and any text under a model without languages get ``und`` and 0. Languages that tie
    are taken in order of name. Columns called ``lang_pred`` or ``score`` are replaced.
    """
    def make():
        langs, table = model.langs, model.table
        longest = max(map(len, table), default=1)
        hold("language", _CACHE.clear)
        if model.mark not in _CACHE:
            _CACHE.clear()
            _CACHE[model.mark] = Sums(len(langs))
        cache = _CACHE[model.mark]

        def judge(counts: Counter):
            # The runs may consist of other numerals, such as superscripts, alone.
            if not langs or not any(c.isalpha() for word in counts for c in word):
                return UNKNOWN, 0.0
            sums = cache.of(counts)
            best = int(sums.argmax())  # the first of equal ones
            return langs[best], float(1.0 / np.exp(sums - sums[best]).sum())

        def work(texts):
            got = []
            for group in groups(texts):
                counts = [Counter(words_of(t)) for t in group]
                if len(cache.place) > CACHE_ENTRIES:
                    cache.place.clear()
                fresh = {w for c in counts for w in c if w not in cache.place} if langs else ()
                cache.add(forward(list(fresh), table, len(langs), longest))
                got += [judge(c) for c in counts]
            return [pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())]

        return work

    return with_columns(docs, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())],
                        make)


def op6_language(spark, docs: DataFrame) -> DataFrame:
    """Trained on the documents outside the held-out quarter; applied to all. A null id is not held out nor learned from."""
    part = fold("doc_id", 4)
    model = fit(docs.where(part != 2))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
