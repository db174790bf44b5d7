"""Flattening of nested records, driven by the schema."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import named


def json_normalize(df: DataFrame) -> DataFrame:
    """Structs become dotted columns at every depth; arrays stay whole."""

    def leaves(fields: list[T.StructField], parent: Column | None, prefix: str) -> list[Column]:
        out = []
        for field in fields:
            value = named(field.name) if parent is None else parent.getField(field.name)
            path = prefix + field.name
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType.fields, value, path + ".")
            else:
                out.append(value.alias(path))
        return out

    return df.select(*leaves(df.schema.fields, None, ""))


# A quoted name in a schema's text, which stays as it is.
_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def record_schema(records: DataFrame, column: str = "record") -> T.StructType:
    """The fields of all records of a VARIANT column, merged: one job that returns one row.

    A field that is a number here and a text there, or a value here and an object there, stays a VARIANT; so does an object
    that is empty everywhere. A field without any value is text.
    """
    text = records.agg(F.schema_of_variant_agg(column)).first()[0] or ""
    parts = _QUOTED.split(text)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"\bVOID\b(?!:)", "STRING", parts[i].replace("OBJECT<>", "VARIANT").replace("OBJECT<", "STRUCT<"))
    merged = "".join(parts)
    return T.DataType.fromDDL(merged) if merged.startswith("STRUCT<") else T.StructType([])


def normalize_records(records: DataFrame, column: str = "record", schema: T.StructType | None = None) -> DataFrame:
    """The records' fields as dotted columns at every depth, like ``json_normalize``, for fields that nobody has declared.

    Lists stay whole. Fields of several kinds, which have no one type, become JSON text. With a ``schema`` only its fields
    are read, and no job looks at the records first.
    """
    fields = record_schema(records, column) if schema is None else schema
    typed = records.select(named(column).cast(fields).alias("_record")).select("_record.*")
    flat = json_normalize(typed)
    return flat.select(*[F.to_json(named(f.name)).alias(f.name) if isinstance(f.dataType, T.VariantType) else named(f.name)
                         for f in flat.schema.fields])


def flatten_first(df: DataFrame) -> DataFrame:
    """One level of flattening that keeps only the first element of top-level lists.

    A struct gives ``key_sub`` columns whose values are not flattened further; a list of structs gives
    ``key_sub`` of its first element; a list of scalars gives its first item. Empty lists give nulls. Where
    two columns get the same name, the later one stays.
    """
    flat: dict[str, Column] = {}
    for field in df.schema.fields:
        value, kind = named(field.name), field.dataType
        if isinstance(kind, T.ArrayType):
            value, kind = F.get(value, 0), kind.elementType
        if isinstance(kind, T.StructType):
            for sub in kind.fields:
                flat[f"{field.name}_{sub.name}"] = value.getField(sub.name)
        else:
            flat[field.name] = value
    return df.select(*[c.alias(name) for name, c in flat.items()])


def _or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _first_three(names: Column) -> Column:
    return _or_blank(F.array_join(F.slice(names, 1, 3), ", "))


def study_records(studies: DataFrame) -> DataFrame:
    """Flat trial records out of nested studies; missing text is '' and missing enrollment 0."""
    protocol = F.col("protocolSection")
    ident, design = protocol["identificationModule"], protocol["designModule"]
    status, arms = protocol["statusModule"], protocol["armsInterventionsModule"]
    intervention_names = F.transform(arms["interventions"], lambda i: F.coalesce(i["name"], F.lit("")))
    return studies.select(
        _or_blank(ident["nctId"]).alias("nctId"),
        _or_blank(ident["briefTitle"]).alias("briefTitle"),
        _or_blank(F.array_join(design["phases"], ", ")).alias("phase"),
        _or_blank(design["studyType"]).alias("studyType"),
        _or_blank(status["overallStatus"]).alias("overallStatus"),
        _or_blank(status["startDateStruct"]["date"]).alias("startDate"),
        _or_blank(status["primaryCompletionDateStruct"]["date"]).alias("completionDate"),
        F.coalesce(design["enrollmentInfo"]["count"], F.lit(0)).cast("bigint").alias("enrollment"),
        _first_three(intervention_names).alias("interventions"),
        _first_three(protocol["conditionsModule"]["conditions"]).alias("conditions"),
    )


_BASE = ["nctId", "briefTitle", "phase", "studyType", "overallStatus"]


def _first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy("nctId").limit(limit)


def studies_by_phase(studies: DataFrame, phase: str, limit: int | None = None) -> DataFrame:
    """Trials that list the phase; the phase column then holds the phase asked for."""
    hits = studies.where(F.array_contains(F.col("protocolSection.designModule.phases"), phase))
    records = study_records(hits).withColumn("phase", F.lit(phase))
    records = records.select(*_BASE, "startDate", "completionDate", "enrollment")
    return _first_rows(records, limit)


def studies_by_drug(studies: DataFrame, drug: str, limit: int | None = None) -> DataFrame:
    """Trials with an intervention whose name contains the drug, in any case."""
    interventions = F.col("protocolSection.armsInterventionsModule.interventions")
    hits = studies.where(F.exists(interventions, lambda i: F.lower(i["name"]).contains(drug.lower())))
    records = study_records(hits).withColumn("drug_searched", F.lit(drug))
    records = records.select("drug_searched", *_BASE, "enrollment", "interventions")
    return _first_rows(records, limit)


def recent_studies(studies: DataFrame, start_date: str | None = None, limit: int | None = None) -> DataFrame:
    """All trials, or with ``start_date`` only those whose start date text is not before it."""
    hits = studies
    if start_date is not None:
        hits = hits.where(F.col("protocolSection.statusModule.startDateStruct.date") >= start_date)
    records = study_records(hits).select(*_BASE, "startDate", "completionDate", "enrollment", "conditions")
    return _first_rows(records, limit)


def study_details(studies: DataFrame, nct_id: str) -> DataFrame:
    """The nested protocol of one trial; no row when the id is unknown."""
    return studies.where(F.col("protocolSection.identificationModule.nctId") == nct_id).select("protocolSection.*")
