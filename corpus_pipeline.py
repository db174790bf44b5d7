"""A training-corpus pipeline over ``documents``: language ID, near-duplicates, decontamination, PII, tokenising."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.llm import bpe, decontaminate, language, pii, simhash
from vigilspark.llm.common import kept, read, ship

MIN_LANGUAGE_SCORE = 0.5
# Words of a shingle, and differing bits up to which two fingerprints link.
SHINGLE_WORDS, MAX_BITS = 3, 3


def _wrapped(docs: DataFrame) -> DataFrame:
    """The rows as one column beside their text, so that no column of theirs clashes with an operator's."""
    ship(docs.sparkSession)
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; null, empty and blank texts, those without letters and those of doubtful language
    go. Repeated rows share their fate."""
    rows = _wrapped(docs)
    found = language.identify(rows, language.fit(docs))
    good = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(good).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints connect stays: that of the least id, null ids last.

    Rows that repeat both id and text are copies, too. Null, empty and blank texts have fingerprint zero and link like any
    other; of equal least ids with different texts, which a table of unique ids does not have, one stays.
    """
    ship(spark)
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    marked = simhash.with_fingerprint(docs.select(key.alias("key"), "text"), words_per_shingle=SHINGLE_WORDS)
    groups = simhash.near_groups(kept(marked.select("key", "fp"), "pipeline-simhash"), "key", budget=MAX_BITS)
    stay = groups.where(F.col("key") == F.col("component_id")).select(F.col("key").alias("_key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))
    return keyed.join(stay, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go. Null and empty texts hold none."""
    found = decontaminate.annotate(_wrapped(docs), read(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("_row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans of personal data in its text become their kind in angle brackets, and ``n_chars`` counts
    what is left. Null texts stay null."""
    clean = pii.redact(pii.find(_wrapped(docs))).withColumn("n_chars", F.length("text").cast("long"))
    new = {"text", "n_chars"}
    return clean.select(*[F.col(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with all their columns and their token ids; columns of the new names are replaced. Null and empty
    texts have no ids."""
    made = {"n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256), "ids": F.col("ids")}
    rows = bpe.round_trip(_wrapped(docs))
    return rows.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in made], *[c.alias(n) for n, c in made.items()])


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontamination), ("pii", personal_data), ("bpe", tokenise)]

# SQL can express neither the trained models nor XXH64 nor byte-pair merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
