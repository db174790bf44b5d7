"""Dataset profiles. Each profile is one aggregate pass over the data with a one-row result."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cleaning import type_census
from .columns import is_missing, named

RISK_FEATURES = ["patient_risk_score", "drug_risk_score", "outcome_severity"]


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn the one-row aggregate into one row per entry."""
    return row.select(F.inline(F.array(*entries)))


def target_counts(df: DataFrame, column: str = "is_serious") -> DataFrame:
    """Rows per value of the column and their percentage of all rows."""
    counts = df.groupBy(named(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 6))


def target_analysis(df: DataFrame) -> DataFrame:
    """Class sizes, serious rate and whether the classes differ by at most one row."""
    serious, other = F.col("serious_events"), F.col("non_serious_events")
    return df.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("is_serious") == 1).alias("serious_events"),
        F.count_if(F.col("is_serious") == 0).alias("non_serious_events"),
    ).select(
        "*",
        F.bround(F.try_divide(serious * 100.0, F.col("total_events")), 1).alias("serious_rate_percent"),
        F.when(F.abs(serious - other) <= 1, "balanced").otherwise("imbalanced").alias("class_balance"),
    )


def _risk_aggregates(features: list[str]) -> list[Column]:
    out = []
    for name in features:
        value = named(name).cast("double")
        out += [
            F.avg(value).alias(f"{name}__mean"), F.stddev_samp(value).alias(f"{name}__std"),
            F.min(value).alias(f"{name}__min"), F.max(value).alias(f"{name}__max"),
            F.count_if(value > 0).alias(f"{name}__positive"),
        ]
    return out


def _risk_features(df: DataFrame) -> list[str]:
    return [name for name in RISK_FEATURES if name in df.columns]


def risk_profile(df: DataFrame, digits: int = 3) -> DataFrame:
    """Mean, sample deviation, range and positive count of each risk feature present."""
    features = _risk_features(df)
    row = df.agg(*_risk_aggregates(features))

    def entry(name: str) -> Column:
        stats = [F.bround(named(f"{name}__{s}"), digits).alias(s) for s in ("mean", "std", "min", "max")]
        return F.struct(F.lit(name).alias("feature"), *stats, named(f"{name}__positive").alias("non_zero_count"))

    return _long(row, [entry(name) for name in features])


def lag_profile(df: DataFrame) -> DataFrame:
    lag = F.col("reporting_lag_days").cast("double")
    return df.agg(
        F.bround(F.avg(lag), 1).alias("mean_days"),
        F.bround(F.max(lag), 1).alias("max_days"),
        F.count_if(lag <= 1).alias("quick_reports"),
        F.count_if(lag > 7).alias("delayed_reports"),
    )


def date_range(df: DataFrame, day: Column) -> DataFrame:
    """Earliest and latest valid day and the days between; no row when no day is valid."""
    span = df.select(day.alias("d")).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    return span.where(F.col("first").isNotNull()).select(
        F.date_format("first", "yyyy-MM-dd").alias("earliest_date"),
        F.date_format("last", "yyyy-MM-dd").alias("latest_date"),
        F.datediff("last", "first").alias("date_span_days"),
    )


def _missing_aggregates(df: DataFrame) -> list[Column]:
    return [F.count_if(is_missing(df, name)).alias(f"missing__{i}") for i, name in enumerate(df.columns)]


def _missing_total(df: DataFrame) -> Column:
    return reduce(add, [F.col(f"missing__{i}") for i in range(len(df.columns))])


def _filled_percent(df: DataFrame) -> Column:
    cells = F.col("records") * len(df.columns)
    return (cells - _missing_total(df)) * 100.0 / F.nullif(cells, F.lit(0))


def _records() -> Column:
    return F.count(F.lit(1)).alias("records")


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing cells of every column."""
    row = df.agg(*_missing_aggregates(df))
    return _long(row, [
        F.struct(F.lit(name).alias("column_name"), F.col(f"missing__{i}").alias("missing"))
        for i, name in enumerate(df.columns)
    ])


def missing_total(df: DataFrame) -> DataFrame:
    return df.agg(*_missing_aggregates(df)).select(_missing_total(df).alias("missing"))


def data_quality_score(df: DataFrame) -> DataFrame:
    """Filled cells as a percentage of all cells; 0 for an empty table."""
    row = df.agg(_records(), *_missing_aggregates(df))
    return row.select(F.coalesce(F.bround(_filled_percent(df), 1), F.lit(0.0)).alias("data_quality_score"))


def data_overview(df: DataFrame) -> DataFrame:
    numeric, text = type_census(df)
    return df.agg(_records(), *_missing_aggregates(df)).select(
        F.col("records").alias("total_records"),
        F.lit(len(df.columns)).cast("bigint").alias("total_features"),
        F.coalesce(F.bround(_filled_percent(df), 1), F.lit(0.0)).alias("data_quality_score"),
        F.lit(numeric).cast("bigint").alias("numeric_features"),
        F.lit(text).cast("bigint").alias("categorical_features"),
    )


def ml_readiness(df: DataFrame) -> DataFrame:
    """Completeness, class balance ratio, readiness score and verdict of a feature table."""
    serious, other = F.col("serious_events"), F.col("non_serious_events")
    row = df.agg(
        _records(),
        F.count_if(F.col("is_serious") == 1).alias("serious_events"),
        F.count_if(F.col("is_serious") == 0).alias("non_serious_events"),
        *_missing_aggregates(df),
    )
    numeric, _ = type_census(df)
    scored = row.select(
        "records",
        F.lit(len(df.columns)).cast("bigint").alias("features"),
        F.lit(numeric).cast("bigint").alias("numeric_features"),
        "serious_events",
        "non_serious_events",
        _missing_total(df).alias("missing"),
        F.round(_filled_percent(df), 6).alias("completeness"),
        F.round(F.try_divide(F.least(serious, other).cast("double"), F.greatest(serious, other)), 6)
        .alias("balance_ratio"),
        (_filled_percent(df) > 95).alias("complete"),
    )
    score = F.when(F.col("complete") & (F.col("records") > 10000), 100).otherwise(85)
    return scored.withColumn("ml_ready_score", score).withColumn("ml_ready", F.col("ml_ready_score") >= 90).drop("complete")


def size_verdict(df: DataFrame) -> DataFrame:
    """Whether the table is large enough to train on."""
    return df.agg(_records()).select(
        "records", F.when(F.col("records") < 100, "too small").otherwise("adequate").alias("verdict")
    )


def _insight_row(df: DataFrame) -> DataFrame:
    has = set(df.columns)
    aggregates = [_records(), *_missing_aggregates(df)]
    if "is_serious" in has:
        aggregates += [
            F.count_if(F.col("is_serious") == 1).alias("serious_events"),
            F.count_if(F.col("is_serious") == 0).alias("non_serious_events"),
        ]
    return df.agg(*aggregates, *_risk_aggregates(_risk_features(df)))


def _insight_texts(df: DataFrame) -> Column:
    """Findings, in order, as an array; findings that do not apply are left out."""
    has, n = set(df.columns), F.col("records")
    findings = [
        F.when(n < 10, F.format_string(
            "Small sample size (%d records) - suitable for proof-of-concept development", n))
        .when(n < 100, F.format_string("Medium sample size (%d records) - good for initial model training", n))
        .otherwise(F.format_string("Large sample size (%d records) - excellent for robust model training", n))
    ]
    if "is_serious" in has:
        rate = F.try_divide(F.col("serious_events") * 100.0, n)
        findings.append(
            F.when(rate == 0, "Current sample contains only non-serious events - "
                              "need diverse data for balanced ML training")
            .when(rate < 10, F.format_string(
                "Low serious event rate (%.1f%%) - typical for post-market surveillance data", rate))
            .when(rate > 50, F.format_string(
                "High serious event rate (%.1f%%) - may indicate focus on high-risk drugs/populations", rate))
        )
    missing = F.try_divide(_missing_total(df) * 100.0, n * len(df.columns))
    findings.append(
        F.when(missing == 0, "Perfect data quality - no missing values detected after cleaning")
        .when(missing < 5, F.format_string("High data quality - minimal missing values (%.1f%%)", missing))
    )
    if "outcome_severity" in has:
        worst = F.col("outcome_severity__max").cast("bigint")
        findings.append(
            F.when(worst == 0, "Current sample shows low-severity outcomes - "
                               "suitable for safety baseline establishment")
            .otherwise(F.format_string("Severity scores range 0-%d - good for outcome prediction modeling", worst))
        )
    if len(df.columns) >= 20:
        findings.append(F.lit(
            f"Rich feature set ({len(df.columns)} features) - excellent foundation for ML model performance"))
    findings.append(F.lit("Pipeline successfully processes FDA data - ready to scale to larger datasets"))
    findings.append(F.lit("Recommend collecting 1000+ records for production-ready ML model training"))
    return F.array_compact(F.array(*findings))


def insights(df: DataFrame) -> DataFrame:
    """Numbered findings about size, class rate, missing cells, severity and width."""
    return _insight_row(df).select(F.posexplode(_insight_texts(df)).alias("pos", "insight")).select(
        (F.col("pos") + 1).alias("insight_no"), "insight"
    )


def report_lines(df: DataFrame, generated_at: str | None = None) -> DataFrame:
    """The profile as numbered text lines, from one aggregate pass."""
    double_rule, rule, blank = F.lit("=" * 80), F.lit("-" * 40), F.lit("")
    n, serious, other = F.col("records"), F.col("serious_events"), F.col("non_serious_events")

    def line(label: str, value: Column, unit: str = "") -> Column:
        return F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("N/A")), F.lit(unit))

    head = [double_rule, F.lit("CLINICAL TRIAL SAFETY MONITORING - EDA REPORT"), double_rule]
    if generated_at is not None:
        head.append(F.lit(f"Generated: {generated_at}"))
    overview = [
        blank, F.lit("DATA OVERVIEW"), rule,
        line("Total Records: ", n),
        F.lit(f"Total Features: {len(df.columns)}"),
        line("Data Quality Score: ", F.coalesce(F.bround(_filled_percent(df), 1), F.lit(0.0)), "/100"),
    ]
    target = [
        blank, F.lit("TARGET VARIABLE ANALYSIS"), rule,
        line("Total Events: ", n),
        line("Serious Events: ", serious),
        line("Non-Serious Events: ", other),
        line("Serious Event Rate: ", F.bround(F.try_divide(serious * 100.0, n), 1), "%"),
        F.when(F.abs(serious - other) <= 1, "Class Balance: Balanced").otherwise("Class Balance: Imbalanced"),
    ] if "is_serious" in df.columns else []
    risks = [blank, F.lit("RISK FACTOR ANALYSIS"), rule]
    for name in _risk_features(df):
        low, high = (F.bround(named(f"{name}__{s}"), 3).cast("string") for s in ("min", "max"))
        risks += [
            F.lit(name.replace("_", " ").title() + ":"),
            line("  Mean: ", F.bround(named(f"{name}__mean"), 3)),
            line("  Range: ", F.concat(low, F.lit(" - "), high)),
            line("  Non-zero: ", named(f"{name}__positive"), " records"),
        ]
    numbered = F.transform(_insight_texts(df), lambda text, i: F.concat((i + 1).cast("string"), F.lit(". "), text))
    foot = [blank, double_rule, F.lit("READY FOR MACHINE LEARNING MODEL DEVELOPMENT"), double_rule]
    lines = F.concat(
        F.array(*head, *overview, *target, *risks, blank, F.lit("BUSINESS INSIGHTS"), rule),
        numbered,
        F.array(*foot),
    )
    return _insight_row(df).select(F.posexplode(lines).alias("pos", "line")).select(
        (F.col("pos") + 1).alias("line_no"), "line"
    )


def write_report(lines: DataFrame, path: str) -> None:
    """Write report lines (about forty) as one UTF-8 text file in order."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def split_balance(split: DataFrame, label: str = "is_serious") -> DataFrame:
    """Share of each class within each part of a split: one pass, one row per part and class."""
    per_part = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(named(label) == 1).alias("n1"),
        F.count_if(named(label) == 0).alias("n0"),
    )
    classes = F.array(*[F.struct(F.lit(k).alias("label"), F.col(f"n{k}").alias("n")) for k in (0, 1)])
    return per_part.select("split", "total", F.inline(classes)).select(
        "split", "label", "n", F.round(F.col("n").cast("double") / F.col("total"), 6).alias("fraction")
    ).where("n > 0")


def minute_summary(events: DataFrame, ts: str = "ts", serious: str = "serious") -> DataFrame:
    """Events and serious events per minute."""
    return (
        events.groupBy(F.date_trunc("minute", F.col(ts)).alias("minute"))
        .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col(serious) == 1).alias("serious_events"))
        .withColumn("serious_percent", F.round(F.col("serious_events") * 100.0 / F.col("events"), 6))
    )


def running_minute_summary(per_minute: DataFrame) -> DataFrame:
    """Per-minute counts with totals so far.

    Running sums are taken within each day and shifted by the totals of the days before, so no task holds
    more than one day of minutes or one row per day.
    """
    days = per_minute.withColumn("day", F.col("minute").cast("date"))
    within = Window.partitionBy("day").orderBy("minute")
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        days.groupBy("day").agg(F.sum("events").alias("e"), F.sum("serious_events").alias("s"))
        .select(
            "day",
            F.coalesce(F.sum("e").over(before), F.lit(0)).alias("events_before"),
            F.coalesce(F.sum("s").over(before), F.lit(0)).alias("serious_before"),
        )
    )
    return (
        days.withColumn("e", F.sum("events").over(within)).withColumn("s", F.sum("serious_events").over(within))
        .join(offsets, "day")
        .select(
            "minute", "events", "serious_events",
            (F.col("e") + F.col("events_before")).alias("total_events"),
            (F.col("s") + F.col("serious_before")).alias("total_serious"),
        )
        .withColumn("total_serious_percent", F.round(F.col("total_serious") * 100.0 / F.col("total_events"), 6))
    )
