"""Counting and reducing per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    """Rows per key. Counted per task before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_digest(df: DataFrame, key: str, name: str = "cnt") -> DataFrame:
    """Rows per MD5 digest of a key.

    Counting by the plain key comes first, so each distinct key is digested once and not
    once per row.
    """
    counted = count_by(df, key, name=name)
    return counted.groupBy(F.md5(F.col(key).cast("binary")).alias("digest")).agg(F.sum(name).alias(name))


def weighted_count(df: DataFrame, key: str, weights: dict[str, int], default: int = 1, name: str = "cnt") -> DataFrame:
    """Rows per key, each counted with its key's weight. The weight is applied to the counts."""
    weight = F.lit(default)
    for word, factor in weights.items():
        weight = F.when(F.col(key) == word, F.lit(factor)).otherwise(weight)
    return count_by(df, key, name=name).withColumn(name, (F.col(name) * weight).cast("bigint"))


def weighted_count_from(
    df: DataFrame, key: str, weights: DataFrame, default: int = 1, name: str = "cnt"
) -> DataFrame:
    """As `weighted_count` with the weights in a frame (key, weight), one row per key.

    The join meets one row per distinct key on both sides, so a hot key cannot skew it.
    """
    counted = count_by(df, key, name=name)
    return counted.join(weights.select(key, "weight"), key, "left").select(
        key, (F.col(name) * F.coalesce("weight", F.lit(default))).cast("bigint").alias(name)
    )


def reduce_by_key(
    df: DataFrame,
    keys: list[str],
    value: str,
    merge: Callable[[pd.Series], object],
    held_keys: int = 100_000,
) -> DataFrame:
    """Reduce a column per key with any associative, commutative function of a Series.

    For functions that Spark lacks; use its own aggregates otherwise. Each task merges its
    rows first, ten times ``held_keys`` or a batch at once, so a row is merged once there; partial results
    then meet sorted by key and are merged as they pass, so no task ever holds a whole group, and a lone one is
    not merged again. Nulls are passed over; a key with nothing else has null. With
    no keys the whole column is reduced to one row, to none when there are no rows at all.
    """
    grouping = keys or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    source = source.select(*grouping, value)

    def merged(table: pa.Table, alone: int) -> pa.Table:
        """One row per key in order of appearance; ``alone`` values of a key or fewer stay as they are."""
        # Arrow types keep whole numbers beside nulls as they are.
        pdf = table.to_pandas(types_mapper=pd.ArrowDtype)
        group = pdf.groupby(grouping, dropna=False, sort=False).ngroup().to_numpy()
        first = np.unique(group, return_index=True)[1]
        full = np.flatnonzero(pdf[value].notna().to_numpy())
        full = full[np.argsort(group[full], kind="stable")]
        values = pdf[value].take(full)
        starts = np.searchsorted(group[full], np.arange(len(first) + 1))
        # A key without values keeps its null, a lone value itself.
        kept = first.copy()
        some = np.flatnonzero(np.diff(starts))
        kept[some] = full[starts[some]]
        many = np.flatnonzero(np.diff(starts) > alone)
        found = [merge(values.iloc[a:b]) for a, b in zip(starts[many].tolist(), starts[many + 1].tolist(), strict=True)]
        column = table.column(value).take(pa.array(kept)).combine_chunks()
        if found:
            mask = np.zeros(len(first), bool)
            mask[many] = True
            results = pd.Series(found, dtype=pd.ArrowDtype(column.type))
            column = pc.replace_with_mask(column, pa.array(mask), pa.array(results, type=column.type))
        rows = table.take(pa.array(first))
        return rows.set_column(table.schema.get_field_index(value), table.schema.field(value), column)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            if rows >= 10 * held_keys:
                yield from merged(pa.Table.from_batches(waiting), 0).to_batches()
                waiting, rows = [], 0
        if rows:
            yield from merged(pa.Table.from_batches(waiting), 0).to_batches()

    def in_key_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            part = merged(rows if held is None else pa.concat_tables([held, rows]), 1)
            # The last key may go on in the next batch.
            yield from part.slice(0, len(part) - 1).to_batches()
            held = part.slice(len(part) - 1)
        if held is not None:
            yield from held.to_batches()

    partial = source.mapInArrow(per_task, source.schema)
    met = partial.repartition(*grouping).sortWithinPartitions(*grouping)
    return met.mapInArrow(in_key_order, source.schema).drop("_all")


# Values of an array of `values_per_key`, on average at most.
ARRAY_VALUES = 10_000


def values_per_key(df: DataFrame, keys: list[str], value: str, name: str = "vals", values: int = ARRAY_VALUES) -> DataFrame:
    """Sorted arrays of a key's distinct values, numbered from 0 in a column ``part``.

    Distinct pairs are formed before anything is collected, so copies never reach an array. Most keys have one
    array; one of more than ``values`` distinct values has its values dealt to as many arrays as it takes, by
    hash, so no array grows with the data. A key without values has an empty array.
    """
    pairs = df.select(*keys, value).distinct()
    sizes = pairs.groupBy(*keys).agg(F.greatest(F.ceil(F.count(value) / values), F.lit(1)).alias("_parts"))
    sizes = sizes.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_parts")
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    met = pairs.join(sizes, same).drop(*[f"_key{i}" for i in range(len(keys))])
    # A null adds nothing to an array, so it joins the first one.
    hashed = F.when(F.col(value).isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.col("_parts")))
    dealt = met.withColumn("part", hashed.cast("int")).drop("_parts")
    return dealt.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(value)).alias(name))
