"""Writing streams to message topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.streaming.results import EVERY_TEN_SECONDS, ResultTable, start_table


def as_messages(df: DataFrame, key: str, value: str) -> DataFrame:
    """The (key, value) text frame that a topic takes."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def send(messages: DataFrame, servers: str, topic: str) -> None:
    """Write a batch of messages to a topic; needs the Kafka connector on the cluster. A topic keeps what a batch sent
    before it failed, so its readers meet a message at least once."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "complete", trigger: dict | None = None
) -> StreamingQuery:
    """Write messages to a topic; needs the Kafka connector on the cluster."""
    writer = messages.writeStream.outputMode(mode).trigger(**(trigger or EVERY_TEN_SECONDS)).format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def start_topic_files(
    messages: DataFrame, folder: str, mode: str = "complete", trigger: dict | None = None
) -> tuple[StreamingQuery, ResultTable]:
    """Write the same messages to files where no broker is at hand."""
    return start_table(messages, folder, mode, keys=["key"], trigger=trigger)
