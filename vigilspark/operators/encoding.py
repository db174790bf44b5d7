"""Category encodings: one-hot columns and codes for the most frequent values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.coerce import as_column
from .columns import named

UNKNOWN = "UNKNOWN"


def one_hot(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Replace the column by one boolean column per value of the domain and one for missing values.

    The columns are part of the schema, so the domain is given. For an open domain use ``top_n_codes``, or Spark's
    ``StringIndexer`` and ``OneHotEncoder``, which keep the values in one vector column. The literal value 'nan' and a
    missing value share the ``_nan`` column.
    """
    values = list(domain)
    text = named(column).cast("string")
    flags = {
        f"{column}_{value}": F.coalesce(text == value, F.lit(False))
        for value in sorted(values) if value != "nan"
    }
    flags[f"{column}_nan"] = text.isNull() | (text == "nan")
    return df.withColumns(flags).drop(column)


def frequent_values(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """One row with, per column, its most frequent values in order (count descending, then value).

    All columns are counted in one pass with map-side partial counts. The rank filter is pushed below the
    shuffle as a group limit, so each task sends at most the largest size per column.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.coalesce(named(name).cast("string"), F.lit(UNKNOWN)).alias("value"))
        for name in sizes
    ])
    counts = df.select(F.inline(pairs)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("value"))
    top = counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= max(sizes.values()))

    def values_of(name: str, size: int) -> Column:
        kept = (F.col("feature") == name) & (F.col("rank") <= size)
        entries = F.sort_array(F.collect_list(F.when(kept, F.struct("rank", "value"))))
        return F.transform(entries, lambda e: e["value"]).alias(name)

    return top.agg(*[values_of(name, size) for name, size in sizes.items()])


def dictionaries(df: DataFrame, sizes: dict[str, int]) -> Column:
    """The frequent values of the columns as one struct: a scalar subquery of at most ``sum(sizes)`` values."""
    return frequent_values(df, sizes).select(F.struct(*[named(name) for name in sizes])).scalar()


def top_n_codes(known: Column, names: Iterable[str]) -> dict[str, Column]:
    """Code columns: rank among the column's most frequent values, 0 for all others.

    ``known`` is the struct of ``dictionaries``, best kept in a column of its own, so that its subquery stands once in the
    plan. A missing value counts as 'UNKNOWN', which always gets 0 but still takes a rank when it is frequent. Coding
    needs no join.
    """
    codes = {}
    for name in names:
        value = F.coalesce(named(name).cast("string"), F.lit(UNKNOWN))
        position = F.array_position(known.getField(name), value).cast("int")
        codes[name] = F.when(value == UNKNOWN, 0).otherwise(F.coalesce(position, F.lit(0)))
    return codes


def generic_name(drug: Column | str) -> Column:
    """Generic name of a known brand, else the name in lower case."""
    text = F.lower(as_column(drug))
    known = F.create_map(*[F.lit(x) for pair in K.BRAND_TO_GENERIC.items() for x in pair])
    return F.coalesce(known[text], text)


def is_serious_outcome(code: Column | str) -> Column:
    return F.coalesce(F.upper(as_column(code)).isin(K.SERIOUS_OUTCOME_CODES), F.lit(False))
