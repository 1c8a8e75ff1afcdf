"""Results of streams as plain tables and views, and starting and ending streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallybrook.session import STREAM_STATE, session_settings

ONCE = {"availableNow": True}
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
BATCH, SLOT, UPTO = "_batch", "_slot", "_upto"
SECONDS_EACH = 0.5
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# What a sink does with one micro-batch and its number.
Write = Callable[[DataFrame, int], None]


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None, whole_state: bool = False) -> Iterator[None]:
    """Settings a stream fixes when it is defined and started: UTC, state in RocksDB, and the
    number of state partitions, which its checkpoint keeps for good.

    The default is a partition per core, and on a cluster no fewer than the session's
    shuffle partitions.

    Each batch stores its changes of the state, and whoever loads the state plays them again. With ``whole_state``
    it stores the state's files: for few large batches whose state is read afterwards, as what a batch has
    added and dropped again is then not played for every reader.
    """
    if state_partitions is None:
        state_partitions = spark.sparkContext.defaultParallelism
        if not spark.sparkContext.master.startswith("local"):
            state_partitions = max(state_partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(state_partitions),
        **STREAM_STATE,
        CHANGES: str(not whole_state).lower(),
    }
    with session_settings(spark, settings):
        yield


def replace_parts(df: DataFrame, path: str, part: str) -> None:
    """Write a partitioned table; of the folders there are, only those that ``df`` has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, empty if nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass
class ResultTable:
    """A stream's result as a Parquet table, written by ``foreachBatch``.

    In update mode each micro-batch has a folder named by its number, so one that runs again replaces itself,
    and reading takes the last state of each key. `compact` is a job of its own for tables of many batches. In
    complete mode the last two results are kept, in two folders by turns, and the later one is
    read. Append mode is Spark's own file sink.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    mode: str
    keys: list[str] = field(default_factory=list)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch; called by Spark once per batch or again after a failure."""
        numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        if self.mode == "complete":
            replace_parts(numbered.withColumn(SLOT, F.lit(batch_id % 2)), self.path, SLOT)
        else:
            replace_parts(numbered, self.path, BATCH)

    def _stored(self, part: str | None = None) -> T.StructType:
        fields = [*self.schema.fields, T.StructField(BATCH, T.LongType())]
        return T.StructType(fields + ([T.StructField(part, T.LongType())] if part else []))

    def batches(self) -> DataFrame:
        """All that update mode has written, with the batch of each row."""
        return read_if_there(self.spark, self.path, self._stored())

    def _merged(self) -> tuple[DataFrame, int]:
        """The rows of the last `compact` and the last batch in them, -1 without one."""
        merged = read_if_there(self.spark, f"{self.path}-merged", self._stored(UPTO))
        upto = merged.agg(F.max(UPTO)).first()[0]
        upto = -1 if upto is None else upto
        return merged.where(F.col(UPTO) == upto).drop(UPTO), upto

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The last state of each key, with its batch."""
        values = [c for c in self.schema.names if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values, BATCH), BATCH).alias("_last"))
        columns = [F.col(c) if c in self.keys else F.col(f"_last.{c}").alias(c) for c in self.schema.names]
        return last.select(*columns, F.col(f"_last.{BATCH}").alias(BATCH))

    def compact(self) -> None:
        """Bring all batches but the last, which may run again, to a row per key, from which reading then starts.

        It may run beside the stream and its readers: it writes one folder and removes nothing. Folders of
        batches up to that one are not read any more; the storage's own rules may let them go.
        """
        merged, upto = self._merged()
        later = self.batches().where(F.col(BATCH) > upto)
        last = later.agg(F.max(BATCH)).first()[0]
        if last is not None and last - 1 > upto:
            rows = self._latest(merged.unionByName(later.where(F.col(BATCH) < last)))
            replace_parts(rows.withColumn(UPTO, F.lit(last - 1).cast("bigint")), f"{self.path}-merged", UPTO)

    def read(self) -> DataFrame:
        """The result so far: the last one in complete mode, the last state of each key in
        update mode, all rows in append mode."""
        if self.mode == "append":
            return read_if_there(self.spark, self.path, self.schema)
        if self.mode == "complete":
            rows = read_if_there(self.spark, self.path, self._stored(SLOT))
            last = rows.agg(F.max(BATCH).alias("_last"))
            return rows.join(F.broadcast(last), F.col(BATCH) == F.col("_last")).select(*self.schema.names)
        merged, upto = self._merged()
        rows = merged.unionByName(self.batches().where(F.col(BATCH) > upto))
        return self._latest(rows).drop(BATCH)


def start_table(
    df: DataFrame,
    folder: str,
    mode: str,
    keys: list[str] | None = None,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    name: str | None = None,
) -> tuple[StreamingQuery, ResultTable]:
    """Write a stream to a `ResultTable` in a folder, with its progress kept beside it.

    ``mode`` is complete, update or append. Update mode needs the result's keys. Starting
    again on the same folder goes on where the stream ended.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of the result")
    table = ResultTable(df.sparkSession, f"{folder}/result", df.schema, mode, keys or [])
    checkpoint = checkpoint or f"{folder}/checkpoint"
    if mode == "append":
        return start_files(df, table.path, checkpoint, trigger, name=name), table
    return start_fan_out(df, [table.write], checkpoint, mode, trigger, name), table


def start_fan_out(
    df: DataFrame,
    writes: list[Write],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Give each micro-batch of one stream to several sinks; the input is read once, and its result computed once.

    A batch is done when all have taken it. After a failure it runs again, so each of ``writes`` must be
    such that a batch written twice stands there once, as with `ResultTable.write` and `replace_parts`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist() if len(writes) > 1 else batch
        try:
            for each in writes:
                each(held, batch_id)
        finally:
            if len(writes) > 1:
                held.unpersist()

    return _named(df.writeStream.outputMode(mode).trigger(**(trigger or ONCE)), name).option(
        "checkpointLocation", checkpoint
    ).foreachBatch(write).start()


def _named(writer, name: str | None):
    return writer.queryName(name) if name else writer


def start_view(
    df: DataFrame, checkpoint: str, mode: str = "complete", trigger: dict | None = None, name: str | None = None
) -> tuple[StreamingQuery, str]:
    """Keep a small result in the driver's memory, as a view under the name returned: Spark's memory sink.

    For a few rows that are looked at while the stream runs; a result that grows belongs in a table.
    """
    name = name or f"result_{uuid.uuid4().hex}"
    writer = df.writeStream.outputMode(mode).trigger(**(trigger or ONCE)).format("memory").queryName(name)
    return writer.option("checkpointLocation", checkpoint).start(), name


def start_with_static(
    df: DataFrame,
    static: Callable[[], DataFrame],
    join: Callable[[DataFrame, DataFrame], DataFrame],
    folder: str,
    mode: str,
    keys: list[str] | None = None,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, ResultTable]:
    """Join each micro-batch of a stream's result to a static side that may change while the stream runs.

    ``static`` is called for every batch, so files that were added since the last one are seen. A frame
    given to a stream's own plan keeps the list of files it was defined with.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of the result")
    table = ResultTable(df.sparkSession, f"{folder}/result", join(df, static()).schema, mode, keys or [])
    write = lambda batch, batch_id: table.write(join(batch, static()), batch_id)
    return start_fan_out(df, [write], f"{folder}/checkpoint", mode, trigger), table


def start_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    format: str = "parquet",
    name: str | None = None,
    **options,
) -> StreamingQuery:
    """Append a stream to files through Spark's own exactly-once file sink."""
    writer = _named(df.writeStream.outputMode("append").trigger(**(trigger or ONCE)), name).format(format)
    return writer.options(**options).option("path", path).option("checkpointLocation", checkpoint).start()


def wait_for_all(*streams: StreamingQuery) -> None:
    """Wait until all streams end. They run side by side; when any fails, whichever its place,
    the others are stopped and its error is raised."""
    waiting = list(streams)
    try:
        while waiting:
            # Returns at once for a stream that has ended, and raises the error it ended with.
            waiting = [stream for stream in waiting if not stream.awaitTermination(SECONDS_EACH)]
    except Exception:
        for stream in streams:
            if stream.isActive:
                stream.stop()
        raise


def run_to_table(
    df: DataFrame, folder: str, mode: str, keys: list[str] | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Process all input there is, end, and return the result table."""
    stream, table = start_table(df, folder, mode, keys, checkpoint=checkpoint)
    wait_for_all(stream)
    return table.read()
