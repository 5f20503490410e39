"""Topics: (key, value, timestamp) messages whose value is JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.parsing import from_message, to_message


def read_topic(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None
) -> DataFrame:
    """Stream of a topic from its earliest offset (needs the connector package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def decode(messages: DataFrame, schema: T.StructType | str, time: str = "EventTime") -> DataFrame:
    """Fields of the message as columns, then the time the topic gave it."""
    text = messages.select(F.col("value").cast("string").alias("value"), "timestamp")
    return text.select(
        from_message("value", schema).alias("message"), F.col("timestamp").alias(time)
    ).select("message.*", time)


def encode(
    df: DataFrame, key: str, fields: list[str] | None = None, time: str | None = None
) -> DataFrame:
    """Rows as (key, value) messages, with ``time`` also with the topic's timestamp."""
    message = to_message(df, key, fields, keep=(time,) if time else ())
    if time:
        message = message.withColumn("timestamp", F.col(time).cast("timestamp")).drop(time)
    return message


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Write (key, value) rows to a topic (needs the connector package)."""
    (
        df.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
