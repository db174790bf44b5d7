"""Mixing sources to target weights by hash thresholds.

Rows are ordered by a hash of their own, so a source's rows below a threshold are a random part of it. The threshold at which
a source's words meet its budget is found without sorting: words are summed by source and bucket of the hash, the bucket in
which the budget is met becomes the new range, and only its rows are summed again, in finer buckets. Budgets beyond a source's
size are nested: every row is taken once, and those below the threshold once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, running

WEIGHTS = (3, 1, 2)
SHARE, REPEATS = 1.5, 2
# Buckets of one histogram are 2 ** BITS; a pass narrows the range of hashes by that factor.
BITS = 12
# Keys that order the rows, with their bits: hash of the id, hash of id, source and text, and a number of the stored row, which
# tells equal rows apart.
KEYS = {"_h1": 60, "_h2": 63, "_h3": 63}
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` out of distinct sources and their sizes.

    Sources in code-point order, null last, weigh ``weights`` over and over, and divide ``share`` times all sizes by weight. A
    target stops at ``repeats`` times its source's size; the excess is divided again among the others until none is above.
    """
    if not 0 <= share <= repeats:
        raise ValueError("the share must lie between 0 and the repeats")
    order = [F.col("source").isNull(), F.col("source")]
    placed = running(sizes.withColumn("_one", F.lit(1).cast("long")), order, "_one", "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    known = kept(placed.select("source", "source_size", weight.alias("weight")), "mix-weights")
    cap = repeats * F.col("source_size")
    total = known.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w"), F.count("*").alias("n")).first()
    words, weight_sum = total.s or 0, total.w or 1
    level, capped = share * words / weight_sum, 0
    while True:  # the level only rises, and each round caps at least one source more
        above = cap < F.lit(level) * F.col("weight")
        over = known.agg(F.count_if(above).alias("n"), F.sum(F.when(above, F.col("source_size"))).alias("s"),
                         F.sum(F.when(above, F.col("weight"))).alias("w")).first()
        if over.n in (capped, total.n):
            break
        capped = over.n
        level = (share * words - repeats * over.s) / (weight_sum - over.w)
    return known.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), cap.cast("double")).alias("target"))


def _within(key: str, width: int) -> Column:
    """Whether the row's key lies in its source's range, which begins at ``low<key>`` and has a power of two in size."""
    return F.shiftright(F.col(key), width) == F.shiftright(F.col("low" + key), width)


def _of(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows with their source's state; null is a source like others."""
    known = state.withColumnRenamed("source", "_source")
    return rows.join(known, rows["source"].eqNullSafe(known["_source"])).drop("_source")


def thresholds(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Where each source's budget is met: ``state`` with the beginning ``low<key>`` of a range of each key, and the ranges'
    widths in bits. Exactly one row of the source, or none, lies in all ranges of the keys that were needed; ``need`` is what
    is left of the budget for it after the rows below.

    Each pass sums the words of the rows within the last ranges by source and bucket, where tasks combine first. All sources
    take their passes together. The number of passes grows with the logarithm of the rows in a source, to five for each key.
    """
    widths, ranges = {}, []
    for key, bits in KEYS.items():
        state = state.withColumn("low" + key, F.lit(0).cast("long"))
        width = bits
        while width:
            held = _of(rows, state)
            for done in ranges:
                held = held.where(_within(done, widths[done]))
            inside = held.where(_within(key, width))
            width = max(0, width - BITS)
            sums = inside.groupBy("source", F.shiftright(F.col(key), width).alias("_bucket")).agg(
                F.sum("size").alias("_words"), F.count("*").alias("_n"), F.min("need").alias("_need"))
            own = Window.partitionBy("source")
            reach = sums.withColumn("_reach", F.sum("_words").over(own.orderBy("_bucket")))
            # The first bucket in which the budget is met; one that rounding leaves unmet ends in the last.
            edge = F.coalesce(F.min(F.when(F.col("_reach") >= F.col("_need"), F.col("_bucket"))).over(own),
                              F.max("_bucket").over(own))
            chosen = reach.withColumn("_edge", edge).where("_bucket = _edge").select(
                "source", (F.col("_need") - (F.col("_reach") - F.col("_words"))).alias("_left"),
                F.shiftleft("_bucket", width).alias("_low"), "_n")
            joined = _of(state, chosen)  # every source with rows has an edge
            state = kept(joined.select(*[c for c in state.columns if c not in ("need", "low" + key)],
                                       F.col("_left").alias("need"), F.col("_low").alias("low" + key),
                                       F.col("_n").alias("_n")), "mix-thresholds")
            most = state.agg(F.max("_n")).first()[0]
            state = state.drop("_n")
            if (most or 0) <= 1:
                return state, {**widths, key: width}
        widths[key] = 0
        ranges.append(key)
    return state, widths


def mix(docs: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text", columns: Sequence[str] | None = None,
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The rows with ``size`` (words), ``source_size``, ``target`` (their source's, see ``targets``) and ``copies``, the times
    that the mix takes them: 0 to ``repeats``.

    A source's words taken differ from its target by half of one document at most. Which rows are taken depends on their id,
    source and text alone, so reruns agree; rows equal in all three are interchangeable. Null is a source like others and
    comes last, null texts have size 0, null ids are told apart by their texts, and an empty table gives no rows. ``columns``
    of ``docs`` are carried along, all unless named; of their names ``size``, ``source_size``, ``target`` and ``copies`` are
    replaced. Rows are never sorted or grouped: what is shuffled are sums, at most 4,096 of a source and pass.
    """
    new = ["size", "source_size", "target", "copies"]
    carried = [c for c in (docs.columns if columns is None else columns) if c not in new]
    id_hash = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 15), 16, 10).cast("long")
    row_hash = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), source, text), 1)
    rows = kept(docs.select(
        F.struct(*carried).alias("row"), F.col(source).alias("source"), n_words(text).alias("size"),
        F.coalesce(id_hash, F.lit(0).cast("long")).alias("_h1"), row_hash.alias("_h2"),
        F.monotonically_increasing_id().alias("_h3")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = targets(sizes, weights=weights, share=share, repeats=repeats)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)).cast("int")
    state = kept(known.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")),
                 "mix-needs")
    found, widths = thresholds(rows.drop("row"), state)
    more = 2 * F.col("need") > F.col("size")  # the row at the edge, if that is nearer to the target than without it
    for name in reversed(list(widths)):
        low, width = F.col("low" + name), widths[name]
        more = F.when(_within(name, width), more).otherwise(F.col(name) < low)
    done = _of(rows, found).withColumn("copies", F.col("whole") + more.cast("int"))
    return done.select(*[F.col("row").getField(c).alias(c) for c in carried], *new)


def op12_mixing(spark, docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its source's target and the words that the mix takes of it: its size times 0, 1 or 2."""
    mixed = mix(docs.select("doc_id", "source", "text"), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
