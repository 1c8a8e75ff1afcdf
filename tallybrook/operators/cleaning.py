"""Duplicates, nulls and rows that do not fit a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key. With ``order`` the survivor is the first row in that order, so it
    does not change from run to run; each task keeps one row per key before the shuffle."""
    if order is None:
        return df.dropDuplicates(keys)
    lead = order + [c for c in df.columns if c not in order]
    first = df.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("_row"))
    return first.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def drop_nulls(df: DataFrame, columns: list[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=columns)


def replace_values(df: DataFrame, replacements: dict, columns: list[str]) -> DataFrame:
    return df.na.replace(replacements, subset=columns)


def conform(df: DataFrame, schema: T.StructType, rejects: str = "_rejects", raw: str = "_raw") -> DataFrame:
    """Bring loaded rows to a declared schema, by name.

    ``rejects`` lists what was wrong with a row: a value that does not fit its type, or null
    in a column declared not nullable. `accepted` and `rejected` part the two kinds; the latter
    keeps each row as it was loaded in a struct named by ``raw``, so that it can be mended.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    problems = []
    for f in schema.fields:
        fits = F.col(f.name).try_cast(f.dataType).isNotNull()
        problems.append(F.when(F.col(f.name).isNotNull() & ~fits, F.lit(f"{f.name}: bad value")))
        if not f.nullable:
            problems.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: missing")))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*typed, F.array_compact(F.array(*problems)).alias(rejects), F.struct("*").alias(raw))


def accepted(conformed: DataFrame, rejects: str = "_rejects", raw: str = "_raw") -> DataFrame:
    return conformed.where(F.size(rejects) == 0).drop(rejects, raw)


def rejected(conformed: DataFrame, rejects: str = "_rejects") -> DataFrame:
    return conformed.where(F.size(rejects) > 0)


VERDICT = "verdict"


def write_by_verdict(conformed: DataFrame, path: str, rejects: str = "_rejects", raw: str = "_raw") -> dict[str, int]:
    """Write accepted and rejected rows of `conform` to two folders in one pass, and count both on the way.

    The folders are ``verdict=accepted`` and ``verdict=rejected``; rows go where they are, without a shuffle. Rows as
    they were loaded are kept for the rejected only. The counts are those of the job that wrote.
    """
    seen, good = Observation(), F.size(rejects) == 0
    rows = conformed.withColumn(VERDICT, F.when(good, "accepted").otherwise("rejected"))
    rows = rows.withColumn(raw, F.when(~good, F.col(raw)))
    counted = rows.observe(seen, F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"))
    counted.write.partitionBy(VERDICT).parquet(path)
    return dict(seen.get)
