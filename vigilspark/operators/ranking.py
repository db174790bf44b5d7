"""Ranks and running sums over whole tables, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .columns import named

# A row's number within its task, as ``monotonically_increasing_id`` lays it out.
_IN_TASK = (1 << 33) - 1


def _dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in ranges of the order, stored, with its range ``_part`` and its number there, ``_at``."""
    spark = df.sparkSession
    path = scratch_dir(spark, "ranges")
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.withColumns({
        "_part": F.shiftrightunsigned("_id", 33).cast("int"), "_at": F.col("_id").bitwiseAND(F.lit(_IN_TASK))}).drop("_id")


def _before_part(dealt: DataFrame, amount: Column) -> Column:
    """What lies in earlier ranges, by range. The driver adds up one number a range."""
    totals = {r[0]: r[1] for r in dealt.groupBy("_part").agg(F.sum(amount)).collect()}
    before, entries = 0, []
    for part in sorted(totals):
        entries += [F.lit(part), F.lit(before).cast("bigint")]
        before += totals[part] or 0
    return F.create_map(*entries)[F.col("_part")] if entries else F.lit(0).cast("bigint")


def with_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the number of rows before each in the order. Equal rows should be told apart by further columns, which
    also lets them be dealt out over several ranges."""
    dealt = _dealt(df, order)
    rank = _before_part(dealt, F.lit(1)) + F.col("_at")
    return dealt.select(*[named(c) for c in df.columns], rank.alias(name))


def with_running_sum(df: DataFrame, order: list[Column], amount: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows before each in the order."""
    dealt = _dealt(df, order)
    inner = F.sum(named(amount)).over(Window.partitionBy("_part").orderBy("_at")) - named(amount)
    return dealt.select(*[named(c) for c in df.columns], (_before_part(dealt, named(amount)) + inner).alias(name))


def first_rows(df: DataFrame, coarse: dict[str, Column], fine: list[str], n: int) -> DataFrame:
    """The first n rows in the order of the ``coarse`` columns and then the ``fine`` ones; of equal rows any.

    Rows are counted by coarse value, which must not be null, to find the value at which n is reached. Rows of smaller values
    are all taken, by a filter; only those of that value are ranked, and none meet in one task.
    """
    keyed = df.withColumns(coarse)
    counts = keyed.groupBy(*coarse).agg(F.count(F.lit(1)).alias("_rows"))
    reach = with_running_sum(counts, [F.col(c) for c in coarse], "_rows", "_before")
    cut = reach.where((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n)).first()
    if cut is None:  # fewer rows than n, or none asked for
        return df if n > 0 else df.limit(0)
    below, same = F.lit(False), F.lit(True)
    for c in coarse:
        below = below | (same & (F.col(c) < F.lit(cut[c])))
        same = same & (F.col(c) == F.lit(cut[c]))
    rest = [c for c in df.columns if c not in fine]
    edge = with_rank(keyed.where(same).select(*[named(c) for c in df.columns]), [named(c) for c in [*fine, *rest]], "_rank")
    return keyed.where(below).select(*[named(c) for c in df.columns]).unionByName(
        edge.where(F.col("_rank") < n - cut["_before"]).drop("_rank"))
