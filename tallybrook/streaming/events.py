"""Event-time operators. Each takes a stream or a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.values import field, lenient, usage_percent


def timed_words(lines: DataFrame, value: str = "value", rejects: str | None = "line_rejects") -> DataFrame:
    """Rows (eventTime, word) of lines ``timestamp,word word``; fields after the second are ignored.

    A line without a valid time has no window and goes, and one without a second field has no
    word. Under the name ``rejects`` their numbers appear in the metrics of each micro-batch.
    """
    parsed = lines.select(
        lenient(field(F.col(value), 1), "timestamp").alias("eventTime"),
        F.split(field(F.col(value), 2), " ").alias("words"),
    )
    if rejects:
        parsed = parsed.observe(
            rejects,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("eventTime").isNull()).alias("bad_time"),
            F.count_if(F.col("eventTime").isNotNull() & F.col("words").isNull()).alias("no_words"),
        )
    return parsed.where(F.col("eventTime").isNotNull()).select("eventTime", F.explode("words").alias("word"))


def windowed_count(
    df: DataFrame,
    time: str,
    keys: list[str],
    width: str,
    lateness: str | None = None,
    name: str = "count",
    observed: str | None = None,
) -> DataFrame:
    """Rows per tumbling window and keys.

    ``lateness`` sets the watermark: a row is counted while its window is open and dropped
    later, and the state of closed windows is freed. Without it windows stay open for good. Under the
    name ``observed`` the metrics of each micro-batch show the rows with a time, late or not, as ``given``.
    """
    if observed:
        df = df.observe(observed, F.count(time).alias("given"))
    if lateness:
        df = df.withWatermark(time, lateness)
    return df.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias(name))


def flat_windows(df: DataFrame, window: str = "window") -> DataFrame:
    """The window's bounds as columns window_start and window_end, without a time zone."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(window)["start"].cast("timestamp_ntz").alias("window_start"),
        F.col(window)["end"].cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def keyed_average(
    messages: DataFrame, key: str = "key", value: str = "value", name: str = "average", as_type: str = "double"
) -> DataFrame:
    """Average of the message values per message key; both may be bytes. Values that are no
    numbers are left out. A decimal type makes the sum independent of task order."""
    kind = messages.schema[value].dataType
    number = F.col(value).cast("string") if isinstance(kind, T.BinaryType) else F.col(value)
    keyed = messages.select(F.col(key).cast("string").alias(key), lenient(number, as_type).alias("_number"))
    average = F.try_divide(F.sum("_number").cast("double"), F.count("_number"))
    return keyed.groupBy(key).agg(average.alias(name))


def usage_messages(telemetry: DataFrame, key: str, total: str, free: str) -> DataFrame:
    """Messages (key, value) with the used share in per cent, from totals and free amounts."""
    return telemetry.select(
        F.col(key).cast("string").alias("key"),
        usage_percent(F.col(total), F.col(free)).alias("value"),
    )
