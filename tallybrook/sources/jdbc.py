"""Tables and queries of a relational database, read in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Ranges:
    """How to cut a read into parallel queries: a number, date or timestamp column, the span
    of its values and the number of cuts. Rows outside the span are read by the outer cuts."""

    column: str
    lower: object
    upper: object
    cuts: int


def jdbc_options(
    url: str,
    driver: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    ranges: Ranges | None = None,
    **options,
) -> dict[str, str]:
    """Options of a JDBC read of a table or of a query.

    A number of partitions alone leaves the read in one task, so it is taken from ``ranges``
    only. With ranges a query is passed as a derived table, as Spark cuts no bare query.
    """
    if (table is None) == (query is None):
        raise ValueError("name a table or a query")
    if "numPartitions" in options:
        raise ValueError("give ranges: a number of partitions alone does not split the read")
    settings = {"url": url, "driver": driver, **options}
    if user is not None:
        settings.update(user=user, password=password or "")
    if ranges is None:
        settings.update({"dbtable": table} if table else {"query": query})
    else:
        settings.update(
            dbtable=table or f"({query}) cut_query",
            partitionColumn=ranges.column,
            lowerBound=str(ranges.lower),
            upperBound=str(ranges.upper),
            numPartitions=str(ranges.cuts),
        )
    return settings


def read_jdbc(spark: SparkSession, **settings) -> DataFrame:
    """Read as described by `jdbc_options`; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()


def read_jdbc_parts(
    spark: SparkSession, url: str, driver: str, table: str, conditions: list[str], user: str | None = None, password: str | None = None
) -> DataFrame:
    """Read with one task per condition, for tables whose rows crowd in a few ranges."""
    properties = {"driver": driver}
    if user is not None:
        properties.update(user=user, password=password or "")
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties)
