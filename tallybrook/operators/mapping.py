"""Row functions of the user's own, with a declared result schema."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_function(function: Callable[[pd.Series], pd.Series], returns: str) -> Callable[..., Column]:
    """A column function from a function of whole Series, passed as Arrow batches."""

    def apply(values: pd.Series) -> pd.Series:
        return function(values)

    return F.pandas_udf(apply, returns)


def map_frames(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Map rows batch by batch to rows of a declared schema."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(apply, schema)


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], object],
    function: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """As `map_frames`, with a costly object made once per task and shared by its batches."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = setup()
        for batch in batches:
            yield function(shared, batch)

    return df.mapInPandas(apply, schema)


def as_record(df: DataFrame, value: str, field: str = "number") -> DataFrame:
    """A column mapped to records of one field, of a declared schema."""
    kind = df.schema[value].dataType.simpleString()
    return map_frames(df.select(value), lambda batch: batch.set_axis([field], axis=1), f"`{field}` {kind}")


def for_each_task(df: DataFrame, write: Callable[[int, Iterator[pa.RecordBatch]], None]) -> int:
    """Run a writer on the executors, once per task, with the partition number and its Arrow batches.

    Returns the number of rows written. A task may run again after a lost executor: the
    writer must replace what it wrote under the same number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            for batch in batches:
                rows += batch.num_rows
                yield batch

        write(TaskContext.get().partitionId(), counted())
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["n"])

    return df.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
