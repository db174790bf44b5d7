"""Event and alert tables: creation, keyed appends, integrity checks and the dashboard queries.

A store is a folder. ``tables/<name>`` says which tables it has. A batch of rows, of one table or of several at once, is one
partitioned write below ``batches``, in a folder named by its tables, its writer and its number; it becomes visible when its
row appears below ``commits``, which is written last. So all tables of a batch appear together or not at all, and the same
writer's same batch leaves one copy, however often it is tried.

Within a batch, rows are divided by table and, for events and alerts, by day of creation, so that the dashboard queries read
only the days they ask for. The keys of keyed tables are kept once more, divided by a hash of the key: an insert reads only
the keys that share a bucket with its own. ``compact`` folds the batches of a table into one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import report_day
from ..schemas import STORE_TABLES
from .columns import named

SCOPE, BATCH = "batch_tables", "ingest_batch"
TABLE, DAY, BUCKET = "table_name", "created_day", "key_bucket"
DAILY = ("adverse_events", "safety_alerts")
# Keyed tables, and the parts into which their keys are divided.
KEYS = {"adverse_events": "event_id", "safety_alerts": "event_id"}
KEY_BUCKETS = 32
_COMMIT = T.StructType([T.StructField("committed_at", T.TimestampType())])

# Columns that no row may leave empty.
REQUIRED = {"safety_alerts": ("alert_type", "alert_level")}


def create_tables(spark: SparkSession, root: str, names: Sequence[str] = tuple(STORE_TABLES)) -> None:
    """Create the tables, all four unless told otherwise, where they do not exist yet."""
    for name in names:
        spark.createDataFrame([], STORE_TABLES[name]).write.mode("ignore").parquet(f"{root}/tables/{name}")
    commits = T.StructType([*_COMMIT.fields, *[T.StructField(c, T.StringType()) for c in (SCOPE, BATCH)]])
    spark.createDataFrame([], commits).write.mode("ignore").partitionBy(SCOPE, BATCH).parquet(f"{root}/commits")


def committed(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Tables and name of every batch that is complete: one entry per batch, which ``compact`` keeps few."""
    schema = T.StructType([*_COMMIT.fields, *[T.StructField(c, T.StringType()) for c in (SCOPE, BATCH)]])
    rows = spark.read.schema(schema).parquet(f"{root}/commits").select(SCOPE, BATCH).collect()
    return sorted((r[0], r[1]) for r in rows)


def _read(spark: SparkSession, root: str, part: str, fields: list[T.StructField]) -> DataFrame:
    # Which batches are complete is settled before their files are listed, so none is seen half.
    paths = [f"{root}/batches/{SCOPE}={scope}/{BATCH}={batch}" for scope, batch in committed(spark, root)
             if part.removesuffix(_INDEX) in scope.split("+")]
    layout = [T.StructField(c, T.StringType()) for c in (SCOPE, BATCH, TABLE)] + [
        T.StructField(DAY, T.DateType()), T.StructField(BUCKET, T.IntegerType())]
    schema = T.StructType([*fields, *layout])
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{root}/batches").parquet(*paths)
    return rows.where(F.col(TABLE) == part)


_INDEX = "_keys"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with its declared columns, its batch and, where it has one, its day of creation. Complete batches alone."""
    rows = _read(spark, root, name, list(STORE_TABLES[name].fields))
    return rows.drop(SCOPE, TABLE, BUCKET, *([] if name in DAILY else [DAY]))


def key_bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(named(key)), F.lit(KEY_BUCKETS)).cast("int")


def read_keys(spark: SparkSession, root: str, name: str, batch: DataFrame | None = None) -> DataFrame:
    """The keys of a keyed table. With a ``batch`` of rows, only those that share a bucket with one of its keys: the buckets,
    at most ``KEY_BUCKETS`` numbers, become a partition filter, so no other key is read."""
    key = KEYS[name]
    stored = _read(spark, root, name + _INDEX, [STORE_TABLES[name][key]])
    if batch is not None:
        wanted = batch.where(named(key).isNotNull()).select(key_bucket(key).alias("b")).distinct().collect()
        stored = stored.where(F.col(BUCKET).isin([r.b for r in wanted]))
    return stored.select(key)


def conform(rows: DataFrame, name: str, now: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows in the declared columns and types of a table, with the table's defaults for absent columns.

    Columns named in ``keep`` are carried along.
    """
    stamp = F.current_timestamp() if now is None else now
    defaults = {"created_at": stamp, "updated_at": stamp, "timestamp": stamp, "is_reviewed": F.lit(False)}
    out = []
    for field in STORE_TABLES[name].fields:
        default = defaults.get(field.name, F.lit(None))
        if field.name not in rows.columns:
            value = default
        elif isinstance(field.dataType, T.DateType) and isinstance(rows.schema[field.name].dataType, T.StringType):
            value = report_day(named(field.name))
        elif isinstance(rows.schema[field.name].dataType, T.StringType):
            value = named(field.name).try_cast(field.dataType)
        else:
            value = named(field.name)
        if field.name in ("created_at", "updated_at", "timestamp", "is_reviewed"):
            value = F.coalesce(value, default)
        out.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*out, *keep)


def batch_name(writer: str, batch_id: str | int) -> str:
    return f"{writer}-{batch_id}"


def _scope(names: Sequence[str]) -> str:
    return "+".join(sorted(names))


def is_committed(spark: SparkSession, root: str, names: Sequence[str], batch_id: str | int, writer: str) -> bool:
    return (_scope(names), batch_name(writer, batch_id)) in committed(spark, root)


def _complete(rows: DataFrame, name: str) -> DataFrame:
    """The rows of a table; one without a required value is an error of the job."""
    for column in REQUIRED.get(name, ()):
        missing = F.raise_error(F.lit(f"{name}.{column} may not be null")).cast(rows.schema[column].dataType)
        rows = rows.withColumn(column, F.coalesce(named(column), missing))
    return rows


def _laid_out(rows: DataFrame, name: str) -> DataFrame:
    """A table's rows and, if it is keyed, its keys, with the folders they belong to."""
    day = F.to_date("created_at") if name in DAILY else F.lit(None).cast("date")
    data = rows.withColumns({TABLE: F.lit(name), DAY: day, BUCKET: F.lit(None).cast("int")})
    if name not in KEYS:
        return data
    key = KEYS[name]
    keys = rows.where(named(key).isNotNull()).select(key).withColumns(
        {TABLE: F.lit(name + _INDEX), DAY: F.lit(None).cast("date"), BUCKET: key_bucket(key)})
    return data.unionByName(keys, allowMissingColumns=True)


def write_batch(parts: Mapping[str, DataFrame], root: str, batch_id: str | int, writer: str = "bulk",
                before_commit: Callable[[], None] | None = None) -> None:
    """Append rows to several tables as one batch of a writer; the same writer's same batch is replaced.

    All rows are one write, rebalanced by folder first: a folder's rows then lie in few files, and adaptive execution splits
    one that holds more than its share over several tasks. A run that ends before the commit, in the write or in
    ``before_commit``, leaves nothing that ``read_table`` shows.
    """
    scope, own = _scope(list(parts)), batch_name(writer, batch_id)
    spark = next(iter(parts.values())).sparkSession
    create_tables(spark, root, list(parts))
    commit = f"{root}/commits/{SCOPE}={scope}/{BATCH}={own}"

    def sign(row: list) -> None:
        spark.createDataFrame(row, _COMMIT).select(F.current_timestamp().alias("committed_at")).coalesce(1).write.mode(
            "overwrite").parquet(commit)

    if (scope, own) in committed(spark, root):
        sign([])  # what is about to be replaced is no longer shown
    rows = None
    for name, part in parts.items():
        one = _laid_out(_complete(part, name), name)
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    # Under dynamic overwrite a replay on another day would leave the first one's days in place.
    rows.hint("rebalance", TABLE, DAY, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        TABLE, DAY, BUCKET).parquet(f"{root}/batches/{SCOPE}={scope}/{BATCH}={own}")
    if before_commit is not None:
        before_commit()
    sign([(None,)])


def append_batch(rows: DataFrame, root: str, name: str, batch_id: str | int, writer: str = "bulk") -> None:
    """Append rows to one table as one batch of a writer; the same writer's same batch is replaced, whatever days it held."""
    write_batch({name: rows}, root, batch_id, writer)


def compact(spark: SparkSession, root: str, name: str, into: str) -> DataFrame:
    """Write all batches of a table as one batch below another root, and return the table there.

    The old root is left as it is; readers and writers move on when the copy is complete.
    """
    rows = read_table(spark, root, name).drop(BATCH, DAY)
    create_tables(spark, into, [name])
    append_batch(rows, into, name, 0, "compacted")
    return read_table(spark, into, name)


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest row of every key, equal times broken by the row's values.

    Partial results are kept per task, so a hot key is no hot partition.
    """
    rest = [order] + [c for c in rows.columns if c not in (key, order)]
    picked = rows.groupBy(key).agg(F.min(F.struct(*[named(c) for c in rest])).alias("row"))
    return picked.select(key, "row.*").select(*[named(c) for c in rows.columns])


def insert_ignore(batch: DataFrame, stored: DataFrame, order: str, key: str = "event_id") -> DataFrame:
    """The batch's rows to append: first row per key, and only keys the store lacks. Null keys never clash.

    Of the store only the keys of this batch are kept before the anti join. Both are equi-joins on the key; adaptive
    execution broadcasts the batch's keys where they are few. ``order`` is the column that says which row came first.
    ``stored`` need hold no more than the keys that ``read_keys`` gives for the batch.
    """
    first = first_per_key(batch.where(named(key).isNotNull()), key, order)
    present = stored.select(key).join(first.select(key), key, "left_semi").distinct()
    accepted = first.join(present, key, "left_anti").select(*batch.columns)
    return accepted.unionByName(batch.where(named(key).isNull()))


def alerts_with_event(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts that keep the foreign key: their event exists, or they name none."""
    named_one = alerts.where("event_id IS NOT NULL").join(events.select("event_id"), "event_id", "left_semi")
    return named_one.select(*alerts.columns).unionByName(alerts.where("event_id IS NULL"))


def orphan_alerts(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts that name an event which does not exist."""
    keyed = alerts.where("event_id IS NOT NULL")
    return keyed.join(events.select("event_id"), "event_id", "left_anti").select(*alerts.columns)


def _since(as_of: Column | None, hours: int) -> Column:
    now = F.current_timestamp() if as_of is None else as_of
    return now - F.make_dt_interval(hours=F.lit(hours))


def recent_alerts(
    alerts: DataFrame,
    events: DataFrame,
    hours: int = 24,
    alert_level: str | None = None,
    as_of: Column | None = None,
    tie_break: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Alerts of the last hours with report id and receive date of their event, newest first.

    The time and level filters run on the alert scan; the join with the events is a plain equi-join, for which adaptive
    execution broadcasts a day's worth of alerts where they are few.
    """
    since = _since(as_of, hours)
    recent = alerts.where(F.col("created_at") >= since)
    if DAY in alerts.columns:  # a day of margin, as the writer's session zone may differ
        recent = recent.where(F.col(DAY) >= F.date_sub(F.to_date(since), 1))
    if alert_level is not None:
        recent = recent.where(F.col("alert_level") == alert_level)
    details = events.select("event_id", "safetyreportid", "receivedate")
    return (
        recent.join(details, "event_id")
        .select(*alerts.columns, "safetyreportid", "receivedate")
        .orderBy(F.desc("created_at"), *tie_break)
    )


def system_stats(events: DataFrame, alerts: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Event and alert totals and their counts of the last hours, in one row: one pass per table."""
    since = _since(as_of, hours)
    alert_counts = alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((F.col("alert_level") == "HIGH") & (F.col("created_at") >= since)).alias("high"),
    ).select(F.struct("total", "high")).scalar()
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("serious") == 1).alias("serious_events"),
        F.count_if(F.col("created_at") >= since).alias("events_last_24h"),
    ).select(
        "total_events",
        "serious_events",
        alert_counts.getField("total").alias("total_alerts"),
        alert_counts.getField("high").alias("high_alerts_24h"),
        "events_last_24h",
    )
