"""Landed JSON pages and CSV zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import REPORT_PAGE, STUDY_PAGE


def read_report_pages(spark: SparkSession, path: str, schema: T.StructType = REPORT_PAGE, multiline: bool = True) -> DataFrame:
    """One row per report of the pages' ``results``; pages without results give no rows.

    ``multiline=False`` reads one page per line, which lets Spark split large files.
    """
    pages = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return pages.select(F.explode("results").alias("r")).select("r.*")


def read_study_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per trial of the pages' ``studies``."""
    pages = spark.read.schema(STUDY_PAGE).option("multiLine", multiline).json(path)
    return pages.select(F.explode("studies").alias("s")).select("s.*")


def read_page_records(spark: SparkSession, path: str, array: str = "results", multiline: bool = True) -> DataFrame:
    """One row per record of the pages' array, as a VARIANT column ``record`` that keeps every field the pages have.

    Pages without the array, or with something else in its place, give no rows. No schema is declared or inferred: the text is
    parsed once, and ``operators.nested.normalize_records`` gives the records columns.
    """
    name = array.replace("\\", "\\\\").replace("'", "\\'")
    pages = spark.read.option("singleVariantColumn", "page").option("multiLine", multiline).json(path)
    # Exploding an object would give its fields, each with a key.
    return spark.sql(
        "SELECT r.value AS record FROM {pages}, LATERAL variant_explode(try_variant_get(page, '$."
        f"{name}', 'variant')) AS r WHERE r.key IS NULL", pages=pages)


def zone_path(root: str, zone: str, key: str) -> str:
    """Path of a key in the 'raw' zone; every other zone name means 'processed'."""
    return f"{root}/{'raw' if zone == 'raw' else 'processed'}/{key}"


# Every value is quoted, so blanks at the ends, quotes and line breaks come back; this text alone stands for null.
NULL_TEXT = "\\N"
_CSV = {"header": True, "quote": '"', "escape": '"', "nullValue": NULL_TEXT, "emptyValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV, quoteAll=True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """CSV with a header row and a declared schema, so no extra pass infers types.

    Values may hold line breaks; ``multiline=False`` is for files without any, which Spark can then split.
    """
    return spark.read.schema(schema).options(**_CSV, multiLine=multiline).csv(path)
