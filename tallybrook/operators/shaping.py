"""Projection, union, sampling, spreading and naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def project_sql(df: DataFrame, *expressions: str) -> DataFrame:
    """Projection by SQL expressions."""
    return df.selectExpr(*expressions)


def name_columns(df: DataFrame, names: list[str], arrays: dict[str, str] | None = None) -> DataFrame:
    """Name columns by position; ``arrays`` maps a text column to the pattern between its items."""
    named = df.toDF(*names)
    return named.withColumns({c: F.split(c, separator) for c, separator in (arrays or {}).items()})


def unfold(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per array item in place of the array. Rows with no item go."""
    return df.withColumn(name, F.explode(array)).drop(array)


def stack_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name; copies stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Random sample; repeats for the same seed and the same file splits."""
    return df.sample(fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Sample that depends on the key's value only: the same rows on every layout and attempt.

    A row is taken when the MD5 digest of its key lies below the fraction's share of all
    digests.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction lies between 0 and 1")
    if fraction == 1:
        return df.where(F.col(key).isNotNull())
    bound = f"{int(fraction * 16**8):08x}"
    return df.where(F.md5(F.col(key).cast("string").cast("binary")) < bound)


def repartition(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Exactly n partitions, dealt out evenly or by the hash of columns."""
    return df.repartition(n, *columns)


def coalesce(df: DataFrame, n: int) -> DataFrame:
    return df.coalesce(n)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even partitions before a write; rows of a column's value come together, but a value
    that fills more than one partition is split by adaptive execution."""
    return df.hint("rebalance", *columns)
