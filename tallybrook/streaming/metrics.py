"""What running streams say of themselves: metrics of each micro-batch, and the rows in their state."""

from __future__ import annotations

from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallybrook.streaming.results import read_if_there

METRICS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("dropped", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


class BatchMetrics(StreamingQueryListener):
    """Stores what the micro-batches of a session's streams have observed, batch by batch.

    A row per metric: the stream's lasting id, the batch, its input rows, the groups that its watermark
    dropped, that watermark, and the metric with its value. ``path`` may be that of an earlier session. Batches
    that ran again are read once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended, self.changed = spark, path, set(), Condition()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(state.numRowsDroppedByWatermark for state in p.stateOperators)
        rows = [
            (str(p.id), p.batchId, p.numInputRows, dropped, p.eventTime.get("watermark"), f"{name}.{key}", int(value or 0))
            for name, seen in p.observedMetrics.items()
            for key, value in seen.asDict().items()
        ]
        if rows:
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for(self, *streams: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until all that these ended streams have told is stored."""
        runs = {str(stream.runId) for stream in streams}
        with self.changed:
            if not self.changed.wait_for(lambda: runs <= self.ended, seconds):
                raise TimeoutError("the streams' metrics have not arrived")

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        """The metrics of all batches; of a batch that ran again, the last ones."""
        rows = read_if_there(self.spark, self.path, METRICS)
        return rows.groupBy("stream", "batch", "metric").agg(
            F.max(F.struct("input_rows", "dropped", "watermark", "value")).alias("m")
        ).select("stream", "batch", "metric", "m.*")


def rows_dropped_late(metrics: DataFrame, given: str, result: DataFrame, name: str = "count") -> DataFrame:
    """How many rows came after their window was closed, as one row ``late``.

    ``given`` is the metric that counts rows with a time, such as `windowed_count` observes, and ``result`` the
    windowed counts in update mode. A row is counted once or dropped, so what the counts lack was late. The
    input is not read again.
    """
    seen = metrics.where(F.col("metric") == given).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("given"))
    counted = result.agg(F.coalesce(F.sum(name), F.lit(0)).alias("counted"))
    return seen.join(counted).select((F.col("given") - F.col("counted")).alias("late"))


def state_rows(spark: SparkSession, checkpoint: str, batch: int | None = None, **options) -> DataFrame:
    """The rows in a stream's state, as of its last batch or an earlier one: Spark's state data source.

    ``joinSide="left"`` or ``"right"`` names the side of a stream join; ``operatorId`` the operator, if several
    keep state.
    """
    reader = spark.read.format("statestore").options(**options)
    return (reader.option("batchId", batch) if batch is not None else reader).load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The operators of a stream that keep state, with the batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint)
