"""Clickstream topic. Needs Spark's Kafka connector on the classpath; parsing is separate and needs nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.fixed_values import BATCH_MESSAGES, FLUSH_SECONDS
from tillwork.sources.clickstream import as_messages, decode_json


def read_topic(
    spark: SparkSession, servers: str, topic: str, *, group: str, enough: int = BATCH_MESSAGES, seconds: int = FLUSH_SECONDS
) -> DataFrame:
    """Events of a topic as text fields, from the earliest message on.

    A micro-batch starts as soon as ``enough`` messages wait or ``seconds`` have passed, and takes all that wait.
    Progress is kept in the checkpoint of the query, not in the consumer group.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("groupIdPrefix", group)
        .option("minOffsetsPerTrigger", enough)
        .option("maxTriggerDelay", f"{seconds}s")
    )
    return decode_json(reader.load())


def publish(events: DataFrame, servers: str, topic: str) -> None:
    as_messages(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
