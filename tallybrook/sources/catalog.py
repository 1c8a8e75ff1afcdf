"""Views and catalog tables, queried by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session_view(df: DataFrame, name: str) -> str:
    """A view that this session sees."""
    df.createOrReplaceTempView(name)
    return name


def shared_view(df: DataFrame, name: str) -> str:
    """A view that all sessions of the application see, under the name returned."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


def save_catalog_table(df: DataFrame, name: str, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Write files to ``path`` and enter them in the catalog."""
    writer = df.write.mode(mode).option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def save_by_key(
    df: DataFrame, name: str, path: str, keys: list[str], buckets: int, mode: str = "errorifexists"
) -> None:
    """Store a table in ``buckets`` by hash of its keys, each a sorted file.

    Tables stored alike are joined and grouped by these keys without a shuffle, as often as they are read. Choose so
    many buckets that one fits a task; a key that holds much more than a bucket's share makes its bucket as large.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def select_all(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a view or table, by SQL."""
    return spark.sql(f"select * from {name}")
