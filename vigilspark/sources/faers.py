"""Quarterly text tables, delimited by '$'."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.columns import evaluated_once

SEPARATOR = "$"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first line of every file."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # Within the first block of a file, lines are numbered in order.
    first = lines.where("block = 0").withColumn("line", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def _names(header: str) -> list[str]:
    return [c.strip() for c in header.split(SEPARATOR)]


def read_text_table(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, with_file: bool = False
) -> DataFrame:
    """Rows of '$'-delimited UTF-8 files, each read by its own first line, the header.

    Files may order their columns differently or have more of them. Columns are matched by name, in any case; a file
    without one of them gives nulls there. Without ``columns`` all columns of all files come, in order of appearance.

    Rows with too many fields are skipped; short rows are kept and padded with nulls. Spark's CSV reader
    drops or keeps both kinds alike, and judges a row by the columns a query happens to use, so the delimiters
    of each line are counted before the line is parsed. The headers are found first; then one scan parses all files, and
    each column is taken from the place where its file's header has it.
    """
    heads = _headers(spark, path)
    headers = sorted(r.header for r in heads.select("header").distinct().collect())  # as many as there are different headers
    wanted = list(columns) if columns is not None else list(dict.fromkeys(n for h in headers for n in _names(h)))
    extra = ["file"] if with_file else []
    layouts = []
    for header in headers:
        place = {n.lower(): i for i, n in reversed(list(enumerate(_names(header))))}
        layouts.append((header, len(_names(header)), [place.get(c.lower()) for c in wanted]))
    known = spark.createDataFrame(layouts, "header string, width int, places array<int>")
    # One row per file, of which the driver lists each anyway.
    files = heads.join(F.broadcast(known), "header")
    lines = _lines(spark, path).join(F.broadcast(files), "file").where(
        (F.col("value") != F.col("header")) & (F.col("value") != ""))
    # Quoted fields may hold a delimiter, so they are blanked before counting.
    bare = F.when(F.contains("value", F.lit('"')), F.regexp_replace("value", '"[^"]*"', "")).otherwise(F.col("value"))
    delimiters = F.length(bare) - F.length(F.replace(bare, F.lit(SEPARATOR), F.lit("")))
    widest = max([width for _, width, _ in layouts], default=1)
    schema = ", ".join(f"`c{i}` string" for i in range(widest))
    row = F.from_csv("value", schema, {"sep": SEPARATOR, "mode": "PERMISSIVE"})
    rows = evaluated_once(lines.where(delimiters < F.col("width")).select("file", "places", "value"), {"row": row})
    cells = F.array(*[F.col(f"row.c{i}") for i in range(widest)])
    taken = rows.select("file", F.transform("places", lambda p: F.get(cells, p)).alias("taken"))
    return taken.select(*extra, *[F.get("taken", i).alias(c) for i, c in enumerate(wanted)])


def read_members(
    spark: SparkSession, root: str, prefix: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows of one table over all unpacked archives below ``root``, from the member chosen in each, with the archive."""
    chosen = members(spark, root, [prefix.upper()]).collect()  # one row per archive
    base = root.rstrip("/") + "/"
    rows = read_text_table(spark, [r.path for r in chosen], columns, with_file=True)
    archive = F.get(F.split(F.substring_index(F.col("file"), base, -1), "/"), 0)
    return rows.select(archive.alias("archive"), *[c for c in rows.columns if c != "file"])


def members(spark: SparkSession, root: str, prefixes: Sequence[str] = K.FAERS_DEFAULT_TABLES) -> DataFrame:
    """Per unpacked archive below ``root`` and table prefix, the first matching member and its standard name.

    A member is a file, or a folder of part files, directly inside the archive's folder.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    base = root.rstrip("/") + "/"
    parts = F.split(F.substring_index(F.col("path"), base, -1), "/")
    candidates = files.select(
        F.get(parts, 0).alias("archive"),
        F.get(parts, 1).alias("member"),
        F.explode(F.array(*[F.lit(p) for p in prefixes])).alias("prefix"),
    ).where(F.startswith(F.upper(F.col("member")), F.col("prefix")))
    first = candidates.groupBy("archive", "prefix").agg(F.min("member").alias("member"))
    return first.select(
        "archive",
        "prefix",
        "member",
        F.concat(F.lit(base), F.col("archive"), F.lit("/"), F.col("member")).alias("path"),
        F.regexp_extract(F.lower("archive"), r"(\d{4}q\d)", 1).alias("quarter"),
        F.concat(F.lower("prefix"), F.lit("_"), F.col("archive"), F.lit(".txt")).alias("standard_name"),
    )
