"""Streaming jobs as frames; `tallybrook.streaming.results` runs them. All work on batches too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallybrook.functions.text import SPACE, word_rows
from tallybrook.operators.counting import count_by
from tallybrook.operators.joins import range_join, with_attributes
from tallybrook.streaming.events import keyed_average, timed_words, windowed_count
from tallybrook.streaming.results import ResultTable, start_fan_out
from tallybrook.streaming.topics import as_messages, send


def running_word_count(lines: DataFrame, text: str = "value", separator: str = SPACE) -> DataFrame:
    """Words of all lines so far. Empty words are counted here, unlike in the batch jobs."""
    return count_by(word_rows(lines, text, separator, keep_empty=True), "word", name="count")


def windowed_word_count(
    lines: DataFrame, width: str = "5 minutes", lateness: str | None = None, observed: str | None = None
) -> DataFrame:
    """Words per tumbling window of lines ``timestamp,words``; with a lateness, late rows go."""
    return windowed_count(timed_words(lines), "eventTime", ["word"], width, lateness, observed=observed)


def hourly_actions(
    actions: DataFrame,
    profiles: DataFrame,
    user: str,
    action: str,
    time: str,
    profile_key: str,
    lateness: str = "30 minutes",
    width: str = "1 hour",
    broadcast: bool = False,
) -> DataFrame:
    """Actions per hour, user and kind, with the user's profile."""
    counts = windowed_count(actions, time, [user, action], width, lateness)
    return with_attributes(counts, profiles, user, profile_key, broadcast)


def actions_after_posting(
    actions: DataFrame,
    postings: DataFrame,
    action_key: str,
    posting_key: str,
    action_time: str,
    posting_time: str,
    seconds: int = 3600,
    action_lateness: str = "1 hour",
    posting_lateness: str = "5 minutes",
    salts: int = 1,
) -> DataFrame:
    """Actions within an hour of the posting that they refer to. Streams join in append mode only.

    A posting may draw a large share of all actions, also long after the start: ``salts`` spreads
    the actions of each posting over so many parts of the state.
    """
    return range_join(
        actions.withWatermark(action_time, action_lateness),
        postings.withWatermark(posting_time, posting_lateness),
        action_key,
        posting_key,
        action_time,
        posting_time,
        seconds,
        salts,
    )


def start_client_averages(
    messages: DataFrame,
    folder: str,
    servers: str | None = None,
    topic: str | None = None,
    trigger: dict | None = None,
    as_type: str = "double",
) -> tuple[StreamingQuery, ResultTable, ResultTable | None]:
    """Average value per client, to a result table and to a topic, from one reading of the messages.

    Returns the stream, started; the result table; and, when no broker is named, the
    table that stands for the topic.
    """
    averages = keyed_average(messages, as_type=as_type)
    spark, clients = messages.sparkSession, averages.withColumnsRenamed({"key": "client", "average": "average_value"})
    result = ResultTable(spark, f"{folder}/clients", clients.schema, "complete")
    to_table = lambda batch, number: result.write(batch.toDF(*clients.columns), number)
    if servers and topic:
        sent, to_topic = None, lambda batch, _: send(as_messages(batch, "key", "average"), servers, topic)
    else:
        sent = ResultTable(spark, f"{folder}/topic", as_messages(averages, "key", "average").schema, "complete")
        to_topic = lambda batch, number: sent.write(as_messages(batch, "key", "average"), number)
    stream = start_fan_out(averages, [to_table, to_topic], f"{folder}/checkpoint", "complete", trigger)
    return stream, result, sent
