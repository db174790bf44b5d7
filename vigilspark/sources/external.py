"""Kafka topics and JDBC tables. The connector jars come from the cluster, not from this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import constants as K
from ..operators.columns import named


def kafka_read_options(
    servers: str, topic: str = K.TOPIC_EVENTS, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_write_options(servers: str, topic: str, acks: str | None = None, retries: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if acks is not None:
        options["kafka.acks"] = acks
    if retries is not None:
        options["kafka.retries"] = str(retries)
    return options


def read_events_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Event messages as text key, text value and broker timestamp."""
    stream = spark.readStream.format("kafka").options(**kafka_read_options(servers, **options)).load()
    return stream.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def as_messages(rows: DataFrame, key: Column, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows as key and JSON value, the form a topic takes."""
    value = F.to_json(F.struct(*[named(c) for c in fields or rows.columns]))
    return rows.select(key.cast("string").alias("key"), value.alias("value"))


def write_events_topic(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Event sink that waits for all replicas and retries three times."""
    options = kafka_write_options(servers, K.TOPIC_EVENTS, acks="all", retries=3)
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


def write_alerts_topic(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    options = kafka_write_options(servers, K.TOPIC_ALERTS)
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


def jdbc_write_options(url: str, table: str, batch_size: int = 1000, **properties: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "stringtype": "unspecified", **properties}


def append_jdbc(rows: DataFrame, url: str, table: str, **properties: str) -> None:
    rows.write.format("jdbc").mode("append").options(**jdbc_write_options(url, table, **properties)).save()


def read_jdbc(spark: SparkSession, url: str, table: str, **properties: str) -> DataFrame:
    """A table read through JDBC; filters and column choice are pushed into its query."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
