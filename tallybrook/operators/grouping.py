"""Sums, averages and chained aggregates per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _addend(df: DataFrame, value: str, exact: str | None) -> tuple[Column, str]:
    """The column as summed, and the type of the sum.

    The sum of doubles depends on the order in which tasks finish. ``exact`` names a decimal
    type that holds the values; sums in it are always the same.
    """
    if isinstance(df.schema[value].dataType, T.IntegralType):
        return F.col(value).cast("bigint"), "bigint"
    return F.col(value).cast(exact or "double"), "double"


def sum_avg_by(
    df: DataFrame, keys: list[str], value: str, sum_name: str, avg_name: str, exact: str | None = None
) -> DataFrame:
    """Sum and average of a column per group."""
    addend, sum_type = _addend(df, value, exact)
    total, rows = F.sum(addend), F.count(value)
    return df.groupBy(*keys).agg(
        total.cast(sum_type).alias(sum_name),
        F.try_divide(total.cast("double"), rows).alias(avg_name),
    )


def sum_avg_through_join(
    facts: DataFrame,
    groups: DataFrame,
    on: str,
    keys: list[str],
    value: str,
    sum_name: str,
    avg_name: str,
    exact: str | None = None,
) -> DataFrame:
    """`sum_avg_by` over ``facts`` joined with ``groups``.

    The facts are summed per join key first, at every size: the join then meets one fact row
    per key, whatever share of the facts that key holds.
    """
    groups = groups.select(on, *keys)
    addend, sum_type = _addend(facts, value, exact)
    per_key = facts.groupBy(on).agg(F.sum(addend).alias("_sum"), F.count(value).alias("_rows"))
    return (
        per_key.join(groups, on)
        .groupBy(*keys)
        .agg(
            F.sum("_sum").cast(sum_type).alias(sum_name),
            F.try_divide(F.sum("_sum").cast("double"), F.sum("_rows")).alias(avg_name),
        )
    )


def max_by_group(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """Largest value per group."""
    return df.groupBy(*keys).agg(F.max(value).alias(name or value))


def distribution(df: DataFrame, value: str, name: str = "cnt") -> DataFrame:
    """How often each value occurs, in ascending order of the value."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias(name)).orderBy(value)


def average_of_text(
    df: DataFrame, keys: list[str], value: str, name: str, as_type: str = "double"
) -> DataFrame:
    """Average of numbers held as text; text that is no number is left out."""
    number = F.col(value).try_cast(as_type)
    average = F.try_divide(F.sum(number).cast("double"), F.count(number))
    return df.groupBy(*keys).agg(average.alias(name))
