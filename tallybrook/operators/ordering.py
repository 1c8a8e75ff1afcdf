"""Sorting and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: str, tie: list[str]) -> DataFrame:
    """The k rows with the largest value; ties go by ``tie`` so that results repeat.

    Each task keeps k rows, so only k rows per task are moved.
    """
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie]).limit(k)


def listing(df: DataFrame, by: str, tie: list[str]) -> DataFrame:
    """All rows by falling value, in one order over all partitions."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie])


def sort_by(df: DataFrame, *order: Column | str) -> DataFrame:
    """Multi-key sort with mixed directions."""
    return df.orderBy(*order)


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)
