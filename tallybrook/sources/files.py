"""File tables: text, CSV, JSON, Parquet, ORC, or any other format Spark knows by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_MODES = {"permissive": "PERMISSIVE", "dropmalformed": "DROPMALFORMED", "failfast": "FAILFAST"}
CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession, path: str | list[str], format: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Read a file table. Partition folders such as ``batch=201706`` become columns."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_lines(
    spark: SparkSession, path: str | list[str], min_partitions: int | None = None, line_end: str | None = None
) -> DataFrame:
    """Text lines in a column ``value``. A line end may be named; "\\r" also ends lines otherwise.

    ``min_partitions`` is the least number of partitions: where the scan makes fewer, as of a
    compressed file that it cannot split, the lines are dealt out to so many. A scan of that many or more
    stays as it is, so a large file is read in as many parts as it has. Without it nothing is shuffled.
    """
    options = {"lineSep": line_end} if line_end else {}
    lines = spark.read.options(**options).text(path)
    few = min_partitions and lines.rdd.getNumPartitions() < min_partitions
    return lines.repartition(min_partitions) if few else lines


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "permissive",
    header: bool = True,
    quarantine: bool = False,
    **options,
) -> DataFrame:
    """CSV. Without a schema every column is text; nothing is inferred.

    ``mode`` rules dirty records: permissive puts null for a bad field, dropmalformed leaves
    the row out, failfast fails the job. With ``quarantine`` a permissive read keeps the
    text of each bad record in a column of its own. Options (sep, escape, nullValue,
    dateFormat, ...) go to Spark as they are. Where a dirty field decides about its whole
    row, all columns are parsed even if few are used: a record must not be clean or dirty
    depending on the columns selected later.
    """
    settings = {"header": header, "mode": CSV_MODES[mode.lower()], **options}
    if schema is not None and quarantine:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        settings["columnNameOfCorruptRecord"] = CORRUPT
    table = read_table(spark, path, "csv", schema, **settings)
    if schema is not None and (quarantine or mode.lower() != "permissive"):
        # Always true; it keeps every column in the scan.
        table = table.where(F.hash(*schema.names) >= F.lit(-(2**31)))
    return table


def read_part(spark: SparkSession, file: str | list[str], table: str | None = None) -> DataFrame:
    """Single Parquet files; naming their table's folder adds the partition columns of the path."""
    return read_table(spark, file, "parquet", **({"basePath": table} if table else {}))


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", format: str = "parquet", partition_by: list[str] | None = None, **options
) -> None:
    """Write a file table; mode is append, overwrite, errorifexists or ignore."""
    writer = df.write.mode(mode).format(format).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_pairs(df: DataFrame, key: str, count: str, path: str) -> None:
    """Write counts as text lines ``(key,count)``."""
    df.select(F.format_string("(%s,%d)", F.col(key), F.col(count)).alias("value")).write.text(path)
