"""One table that describes the columns of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_text(f: T.StructField) -> Column:
    """A value as text such that different values have different texts."""
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return (F.col(f.name) + F.lit(0).cast(f.dataType)).cast("string")  # -0.0 is 0.0
    if isinstance(f.dataType, T.BinaryType):
        return F.hex(f.name)
    if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(F.col(f.name).isNotNull(), F.to_json(F.struct(f.name)))
    return F.col(f.name).cast("string")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct values of the named columns, as rows (position, distinct_count).

    Values stand for themselves as 128 bits of hash and their length, so a long text moves no
    more than a number. All columns are laid under each other and made distinct in one shuffle,
    to which a frequent value gives one row per task.
    """
    cells = []
    for i, f in enumerate(df.schema.fields):
        if f.name in columns:
            text = _as_text(f)
            mark = F.struct(F.xxhash64(F.lit(0), text), F.xxhash64(F.lit(1), text), F.length(text))
            cells.append(F.struct(F.lit(i).alias("position"), F.when(text.isNotNull(), mark).alias("cell")))
    values = df.select(F.inline(F.array(*cells))).where(F.col("cell").isNotNull()).distinct()
    return values.groupBy("position").agg(F.count(F.lit(1)).alias("exact_count"))


QUARTERS = (0.25, 0.5, 0.75)
QUARTER_NAMES = ("q25", "q50", "q75")


def profile(df: DataFrame, exact_distinct: list[str] | None = None, rank_error: float = 1e-4) -> DataFrame:
    """A row per column: type, nullability, rows, nulls, distinct values, min, max, mean, stddev, quartiles.

    Distinct values are estimated by a sketch of fixed size per column, the quartiles of numbers by one whose
    rank is off by ``rank_error`` of the rows at most; all that comes from one
    scan that moves a row per task. The columns named in ``exact_distinct`` are counted exactly, which
    moves each of their distinct values.
    """
    entries, aggregates = [], [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        numeric = isinstance(f.dataType, T.NumericType)
        ordered = not isinstance(f.dataType, T.MapType)
        none = F.lit(None)
        aggregates.append(F.count(f.name).alias(f"n{i}"))
        if ordered:
            aggregates += [F.min(f.name).cast("string").alias(f"lo{i}"), F.max(f.name).cast("string").alias(f"hi{i}")]
        if numeric:
            number = F.col(f.name).cast("double")
            aggregates += [F.avg(number).alias(f"mean{i}"), F.stddev(number).alias(f"dev{i}")]
            aggregates.append(F.percentile_approx(number, list(QUARTERS), round(1 / rank_error)).alias(f"q{i}"))
        aggregates.append(F.approx_count_distinct(_as_text(f)).alias(f"d{i}"))
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
                F.col(f"d{i}").alias("distinct_count"),
                (F.col(f"lo{i}") if ordered else none.cast("string")).alias("min_value"),
                (F.col(f"hi{i}") if ordered else none.cast("string")).alias("max_value"),
                (F.col(f"mean{i}") if numeric else none.cast("double")).alias("mean"),
                (F.col(f"dev{i}") if numeric else none.cast("double")).alias("stddev"),
                *(
                    (F.get(F.col(f"q{i}"), k) if numeric else none.cast("double")).alias(q)
                    for k, q in enumerate(QUARTER_NAMES)
                ),
            )
        )
    table = df.agg(*aggregates).select(F.inline(F.array(*entries)))
    names = [c for c in table.columns if c != "position"]
    if exact_distinct:
        # One row per column of the input on both sides.
        table = table.join(F.broadcast(distinct_counts(df, exact_distinct)), "position", "left")
        exact = F.coalesce("exact_count", F.lit(0))
        named = F.when(F.col("column_name").isin(exact_distinct), exact).otherwise(F.col("distinct_count"))
        table = table.withColumn("distinct_count", named)
    return table.select(*names)


# Size of the mergeable sketches: log2 of the registers for distinct values, and items for quartiles. With these a
# count of distinct values is off by 1.6 % as a rule, and a quartile's rank by 0.1 % of the rows.
SKETCH_BITS, SKETCH_ITEMS = 12, 4000


def profile_sketches(df: DataFrame, bits: int = SKETCH_BITS, items: int = SKETCH_ITEMS) -> DataFrame:
    """A row per column with all that `merged_profile` needs, of fixed size, to be stored beside the rows.

    Made once per batch of new rows, it lets a profile be kept up to date without reading old rows again.
    """
    entries, aggregates, none = [], [F.count(F.lit(1)).alias("rows")], F.lit(None)
    for i, f in enumerate(df.schema.fields):
        numeric, whole = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.IntegralType)
        number = F.col(f.name).cast("double") if numeric else none.cast("double")
        value = F.struct(
            (F.col(f.name) if whole else none).cast("decimal(38,0)").alias("whole"),
            (none.cast("double") if whole else number).alias("number"),
            (none.cast("string") if numeric or isinstance(f.dataType, T.MapType) else F.col(f.name).cast("string")).alias("text"),
        )
        value = F.when(F.col(f.name).isNotNull(), value)
        aggregates += [
            F.count(f.name).alias(f"n{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            F.avg(number).alias(f"mean{i}"),
            (F.var_pop(number) * F.count(number)).alias(f"off{i}"),
            F.hll_sketch_agg(_as_text(f), F.lit(bits)).alias(f"d{i}"),
            F.kll_sketch_agg_double(number, F.lit(items)).alias(f"q{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col("rows"),
                *(F.col(f"{c}{i}").alias(c) for c in ("n", "lo", "hi", "mean", "off", "d", "q")),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all rows whose `profile_sketches` are given, in the columns of `profile`."""
    share = F.col("n") * F.col("mean")
    sums = sketches.groupBy("position", "column_name", "data_type").agg(
        F.max("nullable").alias("nullable"),
        F.sum("rows").alias("row_count"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum(share).alias("total"),
        F.sum("off").alias("off"),
        F.sum(share * F.col("mean")).alias("squares"),
        F.hll_union_agg("d").alias("d"),
        F.kll_merge_agg_double("q").alias("q"),
    )
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    # Within the batches and between their means; rounding must not make it negative.
    spread = F.greatest(F.col("off") + F.col("squares") - F.col("total") * mean, F.lit(0.0))
    text = lambda c: F.coalesce(F.col(c)["whole"].cast("string"), F.col(c)["number"].cast("string"), F.col(c)["text"])
    numeric = F.col("total").isNotNull()
    quarters = [
        F.when(numeric & (F.kll_sketch_get_n_double("q") > 0), F.kll_sketch_get_quantile_double("q", F.lit(p))).alias(name)
        for p, name in zip(QUARTERS, QUARTER_NAMES, strict=True)
    ]
    return sums.orderBy("position").select(
        "column_name",
        "data_type",
        "nullable",
        "row_count",
        (F.col("row_count") - F.col("n")).alias("null_count"),
        F.hll_sketch_estimate("d").alias("distinct_count"),
        text("lo").alias("min_value"),
        text("hi").alias("max_value"),
        mean.alias("mean"),
        F.when(numeric & (F.col("n") > 1), F.sqrt(spread / (F.col("n") - 1))).alias("stddev"),
        *quarters,
    )
