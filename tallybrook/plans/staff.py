"""Cleaning employee records and summing up salaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.values import joined, mask_number, mask_salted
from tallybrook.operators.grouping import sum_avg_through_join
from tallybrook.operators.ordering import sort_by


def masked_records(
    df: DataFrame, key: str, label: str, secret: str, renames: dict[str, str] | None = None, salt: str | None = None
) -> DataFrame:
    """Records with an id_name column and a mask in place of a private column.

    With a salt the mask is SHA-256; without one it is a short hash that small domains
    give away.
    """
    mask = mask_salted(F.col(secret), salt) if salt is not None else mask_number(F.col(secret))
    records = df.withColumns({"id_name": joined("_", F.col(key), F.col(label)), "crypto": mask}).drop(secret)
    for old, new in (renames or {}).items():
        records = records.withColumnRenamed(old, new)
    return records


def pay_by_group(
    pay: DataFrame, people: DataFrame, on: str, group: str, value: str, exact: str | None = None
) -> DataFrame:
    """Sum and average of pay per group of people, largest sum first."""
    totals = sum_avg_through_join(pay, people, on, [group], value, f"sum_{value}", f"avg_{value}", exact)
    return sort_by(totals, F.desc(f"sum_{value}"), F.asc(group))
