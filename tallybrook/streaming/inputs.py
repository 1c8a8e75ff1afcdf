"""Replayable stream inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.values import event_time

# Message envelope of a topic; fixed by the topic connector.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def _pace(max_files: int | None, max_bytes: int | None) -> dict[str, object]:
    pace: dict[str, object] = {}
    if max_files:
        pace["maxFilesPerTrigger"] = max_files
    if max_bytes:
        pace["maxBytesPerTrigger"] = max_bytes
    return pace


def line_stream(
    spark: SparkSession, folder: str, line_end: str | None = None, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Lines of the text files that arrive in a folder, in a column ``value``."""
    ends = {"lineSep": line_end} if line_end else {}
    return spark.readStream.options(**ends, **_pace(max_files, max_bytes)).text(folder)


def csv_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    header: bool = True,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options,
) -> DataFrame:
    """Rows of the CSV files that arrive in a folder, with a declared schema."""
    settings = {"header": header, **_pace(max_files, max_bytes), **options}
    return spark.readStream.schema(schema).options(**settings).csv(folder)


def table_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """A Parquet table, one file or a folder of files, read as a stream; all its columns or the named ones.

    Files are taken in order of arrival. Where they do not follow event time, a pace makes
    rows late that one batch would count; so watermarked jobs pace ordered input only.
    """
    # The path is given as a pattern, since a stream takes no plain path of a single file; what
    # would be a pattern in the path itself stands for itself.
    marked = re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/"))
    head, last = re.fullmatch(r"(.*?)(\\?.)", marked, re.DOTALL).groups()
    pattern = f"{head}[{last}]"
    schema = spark.read.parquet(pattern).schema
    if columns:
        schema = T.StructType([schema[c] for c in columns])
    return spark.readStream.schema(schema).options(**_pace(max_files, max_bytes)).parquet(pattern)


def with_event_time(df: DataFrame, column: str, lateness: str | None = None) -> DataFrame:
    """The column as an instant, and a watermark on it where a lateness is given."""
    df = df.withColumn(column, event_time(df, column))
    return df.withWatermark(column, lateness) if lateness else df


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a topic in the envelope; needs the Kafka connector on the cluster."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    return spark.readStream.format("kafka").options(**settings).load()


def as_envelope(df: DataFrame, topic: str, key: str, value: str, offset: str, time: str) -> DataFrame:
    """Rows of a table as messages, so that jobs on messages also run on files."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.col(value).cast("string").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        event_time(df, time).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
