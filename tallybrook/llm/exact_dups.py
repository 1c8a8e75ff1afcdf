"""Exact duplicates by a stateful stream: state per digest on disk, without expiry; hits are settled by whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.llm.common import LOWER, UPPER, lower_ascii, stored
from tallybrook.session import session_settings, work_folder
from tallybrook.streaming.inputs import table_stream
from tallybrook.streaming.results import ONCE, stream_settings, wait_for_all

# Bytes of files that one micro-batch takes on.
BATCH_BYTES = 1 << 38
# A digest is hot if it has more than one row in so many; so no more digests than this can be hot.
HOT_SHARE = 1000

# A store asks for disk as its state grows, not for some MB in advance; there may be many stores on a node.
STORE = {"spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
STATE = "digest binary, doc_id long, file string, row long, n long"


def normal(text: Column) -> Column:
    """What is compared: A-Z lower-cased, null as empty."""
    return lower_ascii(F.coalesce(text.cast("string"), F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame, digest: Callable[[Column], Column], with_text: bool = False) -> DataFrame:
    """(doc_id, digest, file, row) of each document as it is read: where its content lies."""
    place = docs.metadataColumn("_metadata")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normal(F.col("text")).alias("text"),
        place["file_path"].alias("file"),
        place["row_index"].alias("row"),
    )
    text = ["text"] if with_text else []
    return own.select("doc_id", digest(F.col("text")).alias("digest"), "file", "row", *text)


def last_row() -> Column:
    """The row that stays: the one with the largest id, null below all; of equal ids the last place."""
    return F.max(F.struct("doc_id", "file", "row")).alias("last")


def take_in(
    spark: SparkSession,
    path: str,
    state: str,
    digest: Callable[[Column], Column] = sha256,
    max_bytes: int = BATCH_BYTES,
) -> None:
    """Bring the state in folder ``state`` up to date with the files of ``path`` that it has not seen.

    The stream's state, in RocksDB on the executors' disks and in the folder, keeps for each digest the
    stable identifier, the locator (file and row) and the number of its rows, and never drops one. Tasks
    sum up before anything moves, so copies of one text are a row per task. Started again, the
    stream goes on with new files only.
    """
    with stream_settings(spark), session_settings(spark, STORE):
        rows = located(table_stream(spark, path, None, max_bytes, ["doc_id", "text"]), digest)
        held = rows.groupBy("digest").agg(last_row(), F.count("*").alias("n"))
        writer = held.writeStream.outputMode("update").format("noop").trigger(**ONCE)
        wait_for_all(writer.option("checkpointLocation", state).start())


def retained(spark: SparkSession, state: str) -> DataFrame:
    """(digest, doc_id, file, row, n): the stream's state as of its last batch; no rows before the first."""
    try:
        held = spark.read.format("statestore").load(state)
    except PySparkException as error:
        if error.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], STATE)
    last, n = (F.col("value").getField(f.name) for f in held.schema["value"].dataType)
    return held.select(
        F.col("key.digest").alias("digest"), *(last.getField(c).alias(c) for c in ("doc_id", "file", "row")), n.alias("n")
    )


def shared_digests(texts: DataFrame, state: DataFrame) -> DataFrame:
    """(digest) of the hits whose rows do not all have the same bytes.

    A digest with n rows is settled if n rows of one whole text have it. Copies within a task are counted
    there, so a text moves once per task at most, however many copies it has.
    """
    same = texts.groupBy("digest", "text").agg(F.count("*").alias("alike")).select("digest", "alike")
    hits = state.where("n > 1").select(F.col("digest").alias("of"), "n")
    return same.join(hits.hint("merge"), F.col("digest") == F.col("of")).where("alike != n").select("digest").distinct()


def exact_duplicates(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept, file, row) of every row of the Parquet table at ``path``.

    Texts are equal when their bytes are, after A-Z are lower-cased; null counts as empty. Of equal texts
    the row with the largest id stays, one of them where ids repeat; a null id stays only where all are null.
    ``digest`` makes the state's key from the text; texts that share one without being equal are told apart
    by their bytes. ``state`` is the folder of the stream's state, a new one by default; given again, only files
    that it has not seen are taken in. The table needs ``doc_id`` and ``text`` and may have any other
    columns; without rows there is no result.

    Rows find their state by digest. Digests of more than a thousandth of all rows, a thousand at
    most, are broadcast, so no task joins more than a thousandth of the rows for one of them.
    """
    state = state or work_folder(spark, "dedup-state")
    take_in(spark, path, state, digest, max_bytes)
    held = stored(retained(spark, state), "dedup-digests")
    schema = spark.read.parquet(path).schema
    docs = spark.read.schema(T.StructType([schema[c] for c in ("doc_id", "text")])).parquet(path)
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    own = F.struct(F.col("doc_id").alias("keep_id"), F.col("file").alias("keep_file"), F.col("row").alias("keep_row"), "n")
    by_digest = held.select(F.col("digest").alias("of"), own.alias("own"), "n")
    hot = by_digest.where(F.col("n") * HOT_SHARE > total).select("of", "own")
    rows = located(docs, digest)
    marked = stored(rows.join(F.broadcast(hot), F.col("digest") == F.col("of"), "left").drop("of"), "dedup-rows")
    others = by_digest.where(F.col("n") * HOT_SHARE <= total).select("of", "own")
    found = marked.where("own IS NULL").drop("own").join(others.hint("merge"), F.col("digest") == F.col("of")).drop("of")
    found = marked.where("own IS NOT NULL").unionByName(found)
    result = judged(found)
    shared = stored(shared_digests(located(docs, digest, with_text=True), held), "dedup-shared")
    if shared.isEmpty():
        return result
    return result.join(shared, "digest", "left_anti").unionByName(by_bytes(located(docs, digest, with_text=True), shared))


def judged(found: DataFrame) -> DataFrame:
    """The result's columns, from rows and ``own``, the state of their text."""
    here = (F.col("file") == F.col("own.keep_file")) & (F.col("row") == F.col("own.keep_row"))
    return found.select(
        "doc_id", "digest", F.col("own.keep_id").alias("keep_id"), F.col("own.n").alias("group_size"), here.alias("kept"), "file", "row"
    )


def by_bytes(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """The same for rows whose digest several texts share: equal texts, not digests, are one group."""
    rows = texts.join(shared, "digest", "left_semi")
    groups = rows.groupBy(F.col("digest").alias("d"), F.col("text").alias("t")).agg(last_row(), F.count("*").alias("n"))
    own = F.struct(
        F.col("last.doc_id").alias("keep_id"), F.col("last.file").alias("keep_file"), F.col("last.row").alias("keep_row"), "n"
    )
    groups = groups.select("d", "t", own.alias("own"))
    return judged(rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("text") == F.col("t"))))


EXACT_SQL = f"""
WITH texts AS (
  SELECT doc_id, translate(COALESCE(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)
SELECT doc_id, MAX(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
"""
