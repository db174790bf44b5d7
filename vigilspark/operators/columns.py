"""Helpers that look at a schema while the plan is built."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import no_nan, to_number


def named(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def has_any(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def columns_naming(df: DataFrame, terms: Sequence[str]) -> list[str]:
    """Columns whose lower-case name contains one of the terms."""
    return [name for name in df.columns if any(term in name.lower() for term in terms)]


def number(df: DataFrame, name: str) -> Column:
    """The column as double, unreadable values null; numeric columns skip the text checks."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return no_nan(named(name))
    if isinstance(kind, T.NumericType):
        return named(name).cast("double")
    return to_number(named(name))


def with_numbers(df: DataFrame, names: Iterable[str], prefix: str = "_n_") -> DataFrame:
    """Add the named columns' values as doubles, ``<prefix><name>``; names the input lacks are skipped.

    As columns of their own the values are read once per row, however often later expressions use them.
    """
    return df.withColumns({prefix + name: number(df, name) for name in dict.fromkeys(has_any(df, names))})


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in floating-point columns."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return named(name).isNull() | F.isnan(named(name))
    return named(name).isNull()


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def keep_existing(df: DataFrame, essential: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    return df.select(*[named(name) for name in has_any(df, [*essential, *optional])])


def fill_zero(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Missing numbers become 0, missing text '0', missing booleans false."""
    filled = []
    for field in df.schema.fields:
        c = named(field.name)
        if field.name in skip:
            filled.append(c)
        elif is_numeric(field.dataType):
            clean = no_nan(c) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c
            filled.append(F.coalesce(clean, F.lit(0)).cast(field.dataType).alias(field.name))
        elif isinstance(field.dataType, T.StringType):
            filled.append(F.coalesce(c, F.lit("0")).alias(field.name))
        elif isinstance(field.dataType, T.BooleanType):
            filled.append(F.coalesce(c, F.lit(False)).alias(field.name))
        else:
            filled.append(c)
    return df.select(*filled)


def narrow_integers(df: DataFrame, skip: Sequence[str] = ("safetyreportid",)) -> DataFrame:
    """Cast integer columns to the smallest type their values fit.

    The types depend on the data, so this runs one job: a single min/max pass that returns one row.
    """
    wide = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.IntegerType, T.LongType)) and f.name not in skip
    ]
    if not wide:
        return df
    bounds = df.agg(
        *[F.min(named(n)).alias(f"lo{i}") for i, n in enumerate(wide)],
        *[F.max(named(n)).alias(f"hi{i}") for i, n in enumerate(wide)],
    ).first()
    types: dict[str, str] = {}
    for i, name in enumerate(wide):
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if low is None:
            continue
        if high < 127 and low > -128:
            types[name] = "tinyint"
        elif high < 32767 and low > -32768:
            types[name] = "smallint"
    return df.withColumns({name: named(name).cast(kind) for name, kind in types.items()})


def evaluated_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns so that later steps read their values instead of repeating their expressions.

    The optimizer merges neighbouring projections and moves filters below them, which copies an expression
    to every place that uses it; it does neither across a generator, here of exactly one row.
    """
    row = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline_outer(row))
