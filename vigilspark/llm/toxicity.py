"""Toxicity by a factorization machine over hashed terms: weights of terms, and of pairs of terms that occur together."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHE_ENTRIES, fold, kept, with_columns

LETTERS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
# Lengths of the word beginnings that count as terms beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
# Numbers of occurrences in a text from which a term counts once more.
LEVELS = (1, 2, 4)
# Labelled documents that training reads at most, and factors per feature.
SAMPLE, FACTORS = 20_000, 8
# Standard deviations by which the share of toxic documents of a bucket must differ from the whole sample's for it to be a
# feature. Frequent terms without a deviation of their own were tried, too: on the tables they made held-out results worse.
MIN_DEVIATION = 4.0
# Parts that are trained side by side and averaged, rounds of averaging, and passes of each part in a round.
PARTS, ROUNDS, PASSES = 4, 4, 8
BATCH, RATE, FACTOR_RATE, DECAY = 128, 0.2, 0.05, 1e-6
FLAG_AT = 0.7


def terms(word: str) -> list[int]:
    """Buckets of a lower-case word and of its beginnings."""
    return [zlib.crc32(t.encode("utf-8", "replace")) % BUCKETS
            for t in (word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n))]


def at_level(bucket: int, level: int) -> int:
    """The bucket of "this term, at least ``level`` times"."""
    return bucket if level == 1 else (bucket + level * 0x9E3779B1) % BUCKETS


class Terms:
    """The set of buckets of a text, or of the features they stand for if some are chosen."""

    def __init__(self, chosen: dict[int, int] | None = None):
        self.chosen = chosen
        self.wanted = None if chosen is None else {
            c if k == 1 else (c - k * 0x9E3779B1) % BUCKETS for c in chosen for k in LEVELS}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> list[int]:
        counts: dict[int, int] = {}
        known = self.known
        for word, n in Counter(LETTERS.findall(text.lower())).items() if text else ():
            got = known.get(word)
            if got is None:
                got = tuple(b for b in terms(word) if self.wanted is None or b in self.wanted)
                if len(known) >= CACHE_ENTRIES:
                    known.clear()
                if len(word) <= 64:
                    known[word] = got
            for b in got:
                counts[b] = counts.get(b, 0) + n
        found = {at_level(b, k) for b, n in counts.items() for k in LEVELS if n >= k}
        if self.chosen is not None:
            found = {self.chosen[b] for b in found if b in self.chosen}
        return sorted(found)


@dataclass
class Machine:
    """Parameters; a score is the logistic of bias + sum of weights + sum over pairs of the products of their factors."""

    chosen: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, rows: list[list[int]]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(r) for r in rows], np.int64)
        ids = np.array([i for r in rows for i in r], np.int64)
        row = np.repeat(np.arange(len(rows)), sizes)
        sums = np.zeros((len(rows), self.factors.shape[1]))
        squares = np.zeros_like(sums)
        np.add.at(sums, row, self.factors[ids])
        np.add.at(squares, row, self.factors[ids] ** 2)
        linear = np.bincount(row, weights=self.weights[ids], minlength=len(rows))
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1), ids, row, sums

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows)[0], -500, 500)))

    def learn(self, rows: list[list[int]], labels: np.ndarray, passes: int, seed: int) -> None:
        """Adaptive gradient steps on the logistic loss."""
        rng = np.random.default_rng(seed)
        seen_b, seen_w, seen_f = 1e-8, np.full(len(self.weights), 1e-8), np.full(self.factors.shape, 1e-8)
        for _ in range(passes):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                margin, ids, row, sums = self.margins([rows[i] for i in pick])
                slope = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels[pick]) / len(pick)
                gw = np.bincount(ids, weights=slope[row], minlength=len(self.weights)) + DECAY * self.weights
                gf = DECAY * self.factors
                np.add.at(gf, ids, slope[row][:, None] * (sums[row] - self.factors[ids]))
                seen_b += slope.sum() ** 2
                seen_w += gw**2
                seen_f += gf**2
                self.bias -= RATE * slope.sum() / math.sqrt(seen_b)
                self.weights -= RATE * gw / np.sqrt(seen_w)
                self.factors -= FACTOR_RATE * gf / np.sqrt(seen_f)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, bad = Counter(), Counter()
    for b in batches:
        for ids, label in zip(b.column("terms").to_pylist(), b.column("label").to_pylist(), strict=True):
            seen.update(ids)
            if label:
                bad.update(ids)
    keys = list(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array([seen[k] for k in keys], pa.int64()),
         pa.array([bad[k] for k in keys], pa.int64())], names=["bucket", "n", "bad"])


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Machine | None:
    """A machine trained on at most ``sample`` labelled documents, those with the smallest hashes of their keys.

    Terms are counted per class in Spark, and those that deviate from the share of toxic documents are kept; their number is
    bounded by that of the buckets. The sample is dealt out to ``PARTS`` tasks; each improves the machine on its part and the results are averaged,
    round by round. None if the sample has a single class.
    """
    ids = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("label"))
    ids = ids.orderBy(F.xxhash64(key), key).limit(sample)
    # At most ``sample`` ids, so they are broadcast and the texts stay where they are.
    rows = docs.where(F.col(text).isNotNull()).select(key, F.col(text).alias("text")).join(F.broadcast(ids), key)

    def make():
        every = Terms()
        return lambda texts: [pa.array([every.of(t) for t in texts], pa.list_(pa.int32()))]

    made = with_columns(rows.select("label", "text", F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("part")), "text",
                        [T.StructField("terms", T.ArrayType(T.IntegerType()))], make).drop("text")
    termed = kept(made, "toxicity-terms")
    total, bad = termed.agg(F.count("*"), F.sum("label")).first()
    if not total or not bad or bad == total:
        return None
    share = bad / total
    expected = F.col("n") * share
    scored = termed.mapInArrow(_bucket_counts, "bucket int, n long, bad long").groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n >= 4")
    deviation = F.abs(F.col("bad") - expected) / F.sqrt(expected * (1 - share) + 1)
    best = scored.withColumn("z", deviation).where(F.col("z") >= MIN_DEVIATION).orderBy(F.desc("z"), "bucket").collect()
    chosen = {r.bucket: i for i, r in enumerate(best)}
    # Start from half of each feature's log odds, so that a rare feature counts before it has met others.
    odds = [0.5 * (math.log((r.bad + 0.5) / (bad + 1)) - math.log((r.n - r.bad + 0.5) / (total - bad + 1))) for r in best]
    machine = Machine(chosen, math.log(share / (1 - share)), np.array(odds),
                      np.random.default_rng(5).standard_normal((len(chosen), FACTORS)) * 0.01)

    parts = kept(termed.repartition(PARTS, "part").mapInArrow(_chosen_only(chosen), "part int, label int, ids array<int>"),
                 "toxicity-parts")
    for turn in range(ROUNDS):
        def improve(batches, machine=machine, turn=turn):
            own: dict[int, tuple[list, list]] = {}
            for b in batches:
                for part, y, ids in zip(*(b.column(c).to_pylist() for c in ("part", "label", "ids")), strict=True):
                    xs, ys = own.setdefault(part, ([], []))
                    xs.append(ids)
                    ys.append(y)
            for part, (xs, ys) in own.items():
                mine = Machine(machine.chosen, machine.bias, machine.weights.copy(), machine.factors.copy())
                mine.learn(xs, np.array(ys, float), PASSES, 100 * turn + part)
                flat = np.concatenate([[mine.bias], mine.weights, mine.factors.ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([len(xs)]), pa.array([flat.tobytes()], pa.binary())],
                                                 names=["n", "flat"])

        got = parts.repartition(PARTS, "part").mapInArrow(improve, "n long, flat binary").collect()
        mean = sum(r.n * np.frombuffer(r.flat) for r in got) / sum(r.n for r in got)
        size = len(chosen)
        machine = Machine(chosen, float(mean[0]), mean[1 : 1 + size].copy(), mean[1 + size :].reshape(size, FACTORS).copy())
    return machine


def _chosen_only(chosen: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[chosen[t] for t in row if t in chosen] for row in b.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("label").cast(pa.int32()),
                                              pa.array(ids, pa.list_(pa.int32()))], names=["part", "label", "ids"])
    return run


def score(docs: DataFrame, machine: Machine | None, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score``. Null and empty texts get the score of a text without terms; without a
    machine every score is 0. A column called ``score`` is replaced."""
    def make():
        if machine is None:
            return lambda texts: [pa.array([0.0] * len(texts), pa.float64())]
        some = Terms(machine.chosen)
        return lambda texts: [pa.array(machine.scores([some.of(t) for t in texts]), pa.float64())]

    return with_columns(docs, text, [T.StructField("score", T.DoubleType())], make)


def op2_toxicity(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Trained outside the held-out third, applied to all. A null id is not held out nor learned from."""
    part = fold("doc_id", 3)
    machine = fit(docs.where(part != 1), labels.where(part != 1))
    return score(docs.select("doc_id", "text"), machine).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= FLAG_AT).cast("int").alias("predicted"))
