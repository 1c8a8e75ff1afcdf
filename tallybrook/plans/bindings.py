"""The jobs and operators bound to the test tables, as queries by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.text import SPACE_OR_NEWLINE, line_rows, word_rows
from tallybrook.functions.values import event_time, number_label
from tallybrook.operators import cleaning, counting, grouping, joins, mapping, ordering, shaping
from tallybrook.operators.profile import merged_profile, profile, profile_sketches
from tallybrook.plans import lottery, staff, streams, words
from tallybrook.session import session_settings, work_folder
from tallybrook.sources import catalog, files
from tallybrook.streaming import events, inputs, results, topics
from tallybrook.streaming.metrics import BatchMetrics, rows_dropped_late, state_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Amounts of the test tables have two decimals; sums in this type do not depend on task order.
MONEY = "decimal(18,2)"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return inputs.table_stream(spark, f"{sf_dir}/{table}.parquet")


# Tasks that texts are dealt to before they are parted into words; for files of fewer row groups than cores.
TEXT_PARTS: int | None = None


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("text")
    return shaping.repartition(rows, TEXT_PARTS) if TEXT_PARTS else rows


# --- words -------------------------------------------------------------------------------


@query
def wc_top5(spark, sf_dir):
    return words.top_words(texts(spark, sf_dir), "text", 5, SPACE_OR_NEWLINE)


@query
def wc_whitespace(spark, sf_dir):
    return words.word_listing(texts(spark, sf_dir), "text")


@query
def wc_hashed(spark, sf_dir):
    return words.digest_counts(texts(spark, sf_dir), "text", SPACE_OR_NEWLINE)


@query
def wc_hashed_top5(spark, sf_dir):
    counts = words.digest_counts(texts(spark, sf_dir), "text", SPACE_OR_NEWLINE)
    return ordering.top_k(counts, 5, "cnt", ["digest"])


@query
def wc_weighted(spark, sf_dir):
    found = word_rows(texts(spark, sf_dir), "text", SPACE_OR_NEWLINE)
    return counting.weighted_count(found, "word", {"the": 2})


@query
def wc_weight_table(spark, sf_dir):
    """Weights from a table: a word also found in part names counts with its longest part's size."""
    found = word_rows(texts(spark, sf_dir), "text", SPACE_OR_NEWLINE)
    parts = load(spark, sf_dir, "part").select("p_size", F.explode(F.split("p_name", " ")).alias("word"))
    weights = parts.groupBy("word").agg(F.max("p_size").alias("weight"))
    return counting.weighted_count_from(found, "word", weights)


@query
def bigrams(spark, sf_dir):
    return words.pair_counts(line_rows(texts(spark, sf_dir), "text"))


@query
def bigrams_top5(spark, sf_dir):
    return words.top_pairs(line_rows(texts(spark, sf_dir), "text"))


@query
def saved_counts(spark, sf_dir):
    """Counts saved as text lines ``(word,count)`` and read back."""
    folder = work_folder(spark, "saved_counts")
    counts = counting.count_by(word_rows(texts(spark, sf_dir), "text", SPACE_OR_NEWLINE), "word")
    files.write_pairs(counts, "word", "cnt", folder)
    return files.read_lines(spark, folder, line_end="\n")


@query
def text_lines(spark, sf_dir):
    """Document lines written as a text file and counted line by line after reading."""
    folder = work_folder(spark, "text_lines")
    line_rows(load(spark, sf_dir, "documents"), "text").write.text(folder)
    lines = files.read_lines(spark, folder, min_partitions=4, line_end="\n")
    return counting.count_by(lines, "value")


# --- multipliers, groups and joins -------------------------------------------------------


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    return load(spark, sf_dir, "lineitem").withColumn("batch", shipped)


@query
def multiplier_dist(spark, sf_dir):
    entries = batches(spark, sf_dir)
    won = entries.where(F.col("l_returnflag") == "R").select("l_partkey", "batch")
    winners = won.where(F.col("batch") >= 199506).select("l_partkey").distinct().withColumn("batch", F.lit(199506))
    return lottery.multiplier_distribution(entries, winners, "l_partkey", "batch", 199506)


@query
def multiplier_repeat_wins(spark, sf_dir):
    """As `multiplier_dist`, but a part returned more than once is a winner more than once."""
    entries = batches(spark, sf_dir)
    winners = entries.where(F.col("l_returnflag") == "R")
    return lottery.multiplier_distribution(entries, winners, "l_partkey", "batch", 199506)


@query
def partitioned_scan(spark, sf_dir):
    """A table stored by batch; the filter on the batch opens only the folders it needs."""
    folder = work_folder(spark, "partitioned_scan")
    stored = batches(spark, sf_dir).select("l_partkey", "l_quantity", "batch")
    files.write_table(shaping.balanced(stored, "batch"), folder, partition_by=["batch"])
    recent = files.read_table(spark, folder).where(F.col("batch") >= F.lit("199801"))
    return counting.count_by(recent.select("batch"), "batch")


@query
def join_agg_sort(spark, sf_dir):
    pay = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("price"))
    people = load(spark, sf_dir, "customer")
    totals = staff.pay_by_group(pay, people, "c_custkey", "c_mktsegment", "price", MONEY)
    return totals.withColumn("avg_price", F.round("avg_price", 4))


@query
def group_sum_avg(spark, sf_dir):
    totals = grouping.sum_avg_by(
        load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "sum_qty", "avg_qty", MONEY
    )
    return totals.withColumn("avg_qty", F.round("avg_qty", 4))


@query
def average_of_text(spark, sf_dir):
    """Average of amounts held as text, where part of the texts are no numbers."""
    dirty = rough_orders(spark, sf_dir)
    averages = grouping.average_of_text(dirty, ["o_orderstatus"], "o_totalprice", "avg_price", MONEY)
    return averages.withColumn("avg_price", F.round("avg_price", 4).cast("string"))


@query
def composite_counts(spark, sf_dir):
    return counting.count_by(load(spark, sf_dir, "events"), "user_id", "event_type")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name")


def all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")


# Parts that the side an outer join cannot split by itself is dealt to.
SALTS = 8


@query
def join_inner(spark, sf_dir):
    return joins.equi_join(all_orders(spark, sf_dir), customers(spark, sf_dir), "c_custkey")


@query
def join_by_key(spark, sf_dir):
    """Both tables stored by key first, so the join itself shuffles nothing."""
    names = [fresh_name("orders"), fresh_name("customers")]
    for name, table in zip(names, (all_orders(spark, sf_dir), customers(spark, sf_dir)), strict=True):
        catalog.save_by_key(table, name, work_folder(spark, name), ["c_custkey"], 8)
    return joins.equi_join(*[catalog.catalog_table(spark, name) for name in names], "c_custkey")


@query
def join_left(spark, sf_dir):
    return joins.equi_join(customers(spark, sf_dir), all_orders(spark, sf_dir), "c_custkey", "left", "right", SALTS)


@query
def join_right(spark, sf_dir):
    """All documents with their labels, where they have any."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.equi_join(load(spark, sf_dir, "labels"), documents, "doc_id", "right")


@query
def join_semi(spark, sf_dir):
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.equi_join(documents, load(spark, sf_dir, "labels"), "doc_id", "semi")


@query
def join_anti(spark, sf_dir):
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.equi_join(documents, load(spark, sf_dir, "labels"), "doc_id", "anti")


@query
def join_static(spark, sf_dir):
    """Supplier rows with their nation."""
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return joins.with_attributes(suppliers, nations, "s_nationkey", "n_nationkey")


@query
def interval_pairs(spark, sf_dir):
    """Clicks within an hour after a view by the same user, on the whole table at once."""
    with session_settings(spark, {"spark.sql.session.timeZone": "UTC"}):
        clicks, views = clicks_and_views(load(spark, sf_dir, "events"))
        return zoneless(joins.range_join(clicks, views, "user_id", "view_user", "click_ts", "view_ts", 3600))


# --- projection, cleaning, preparation ---------------------------------------------------


@query
def project_expr(spark, sf_dir):
    rich = load(spark, sf_dir, "customer").where("c_acctbal > 0")
    named = shaping.project_sql(rich, "c_custkey", "concat(c_custkey, '_', c_name) as id_name", "c_mktsegment")
    return named.withColumnRenamed("c_mktsegment", "segment")


@query
def mask(spark, sf_dir):
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    renames = {"c_mktsegment": "segment"}
    return staff.masked_records(people, "c_custkey", "c_name", "c_nationkey", renames, salt="brook")


@query
def mask_hash(spark, sf_dir):
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return staff.masked_records(people, "c_custkey", "c_name", "c_nationkey")


@query
def dedup_by_key(spark, sf_dir):
    return cleaning.one_per_key(load(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"])


@query
def dedup_any(spark, sf_dir):
    """One row per key without a say in which: the keys are certain."""
    return cleaning.one_per_key(load(spark, sf_dir, "orders"), ["o_custkey"]).select("o_custkey")


@query
def distinct(spark, sf_dir):
    return cleaning.distinct_rows(load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.equi_join(documents, load(spark, sf_dir, "labels"), "doc_id", "left", "right", SALTS)


@query
def na_fill(spark, sf_dir):
    return cleaning.fill_nulls(labelled(spark, sf_dir), {"quality": -1, "toxic": -1})


@query
def na_drop(spark, sf_dir):
    return cleaning.drop_nulls(labelled(spark, sf_dir), ["quality", "toxic"])


@query
def na_replace(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return cleaning.replace_values(orders, {"F": "finished", "O": "open"}, ["o_orderstatus"])


@query
def union_all(spark, sf_dir):
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    people = load(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    return shaping.stack_rows(parts, people)


@query
def sample_by_key(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return shaping.sample_by_key(orders, "o_orderkey", 0.3)


@query
def sample_random(spark, sf_dir):
    """Facts about a random sample: a part of the table near the share, the same for the same seed."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    one, two = (shaping.sample_rows(orders, 0.3, 7) for _ in range(2))
    facts = one.agg(F.count("*").alias("n")).join(orders.agg(F.count("*").alias("all")))
    facts = facts.join(one.exceptAll(two).agg(F.count("*").alias("other")))
    facts = facts.join(one.join(orders, ["o_orderkey", "o_totalprice"], "left_anti").agg(F.count("*").alias("foreign")))
    near = F.abs(F.col("n") - 0.3 * F.col("all")) <= 5 * F.sqrt(0.21 * F.col("all")) + 1
    return facts.select(near.alias("share_is_near"), (F.col("other") == 0).alias("repeats"), (F.col("foreign") == 0).alias("is_part"))


@query
def repartition_write(spark, sf_dir):
    folder = work_folder(spark, "repartition_write")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    files.write_table(shaping.balanced(orders, "o_custkey"), f"{folder}/balanced")
    stored = files.read_table(spark, f"{folder}/balanced")
    parts = 2 * spark.sparkContext.defaultParallelism
    dealt = shaping.coalesce(shaping.repartition(stored, 2 * parts), parts)
    files.write_table(dealt, f"{folder}/dealt")
    return files.read_table(spark, f"{folder}/dealt")


@query
def explode_array(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    lists = counting.values_per_key(orders, ["o_custkey"], "o_orderpriority", "priorities")
    return shaping.unfold(lists.drop("part"), "priorities", "priority")


@query
def name_columns(spark, sf_dir):
    """A header-less CSV file: columns named by position, one text split into an array."""
    folder = work_folder(spark, "name_columns")
    pairs = load(spark, sf_dir, "part").select("p_partkey", F.translate("p_name", " ", "+").alias("p_name"))
    files.write_table(pairs, folder, format="csv")
    raw = files.read_csv(spark, folder, header=False)
    named = shaping.name_columns(raw, ["id", "words"], arrays={"words": "\\+"})
    return shaping.unfold(named.withColumn("id", F.col("id").cast("bigint")), "words", "word")


def rough_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, with bad amounts for one status and none for one priority."""
    amount = (
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .when(F.col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    orders = load(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").cast("string"), amount.alias("o_totalprice"), "o_orderstatus")


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_totalprice", T.DoubleType(), False),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


@query
def conform_accepted(spark, sf_dir):
    return cleaning.accepted(cleaning.conform(rough_orders(spark, sf_dir), ORDER_SCHEMA))


@query
def conform_rejected(spark, sf_dir):
    bad = cleaning.rejected(cleaning.conform(rough_orders(spark, sf_dir), ORDER_SCHEMA))
    return bad.select("o_orderkey", F.array_join("_rejects", "; ").alias("reasons"), F.col("_raw.o_totalprice").alias("loaded"))


@query
def profile_customer(spark, sf_dir):
    return rounded_profile(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"))


@query
def profile_labelled(spark, sf_dir):
    """A profile of columns with nulls."""
    return rounded_profile(labelled(spark, sf_dir).select("doc_id", "source", "quality"))


def rounded_profile(df: DataFrame) -> DataFrame:
    table = profile(df, exact_distinct=df.columns)
    return table.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query
def profile_merged(spark, sf_dir):
    """The profile of a table that came in two batches, from the sketches stored of each.

    The distinct values of a key column are estimated, so they are not shown.
    """
    folder = work_folder(spark, "profile_sketches")
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    for batch in range(2):
        described = profile_sketches(people.where(F.col("c_custkey") % 2 == batch))
        results.replace_parts(described.withColumn("batch", F.lit(batch)), folder, "batch")
    table = merged_profile(spark.read.parquet(folder))
    estimated = F.when(F.col("column_name") != "c_custkey", F.col("distinct_count"))
    return table.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")}).withColumn("distinct_count", estimated)


@query
def conform_written(spark, sf_dir):
    """Accepted and rejected rows written in one pass: how many were counted on the way, and how many are there."""
    folder = work_folder(spark, "conform_written")
    counts = cleaning.write_by_verdict(cleaning.conform(rough_orders(spark, sf_dir), ORDER_SCHEMA), folder)
    seen = spark.createDataFrame(list(counts.items()), "verdict string, observed long")
    written = counting.count_by(spark.read.parquet(folder), "verdict", name="written")
    return seen.join(written, "verdict")


@query
def preview_and_profile(spark, sf_dir):
    """The first customers by key, each beside the profile of the column that orders them."""
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    first = ordering.first_rows(people, 5, ["c_custkey"])
    described = rounded_profile(people).where(F.col("column_name") == "c_acctbal")
    return first.join(described.select("row_count", "null_count", "distinct_count", "mean", "stddev"))


@query
def first_rows(spark, sf_dir):
    return ordering.first_rows(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 20, ["o_orderkey"])


@query
def sort_mixed(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordering.sort_by(orders, F.desc("o_totalprice"), F.asc("o_orderpriority"))


# --- row functions -----------------------------------------------------------------------


@query
def label_map(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", number_label(F.col("o_orderkey")).alias("label"))


@query
def range_labels(spark, sf_dir):
    """A label for every number in the range of order keys, used or not."""
    top = load(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return spark.range(0, (top or 0) + 1).select(number_label(F.col("id")).alias("label"))


@query
def vector_labels(spark, sf_dir):
    label = mapping.vector_function(lambda numbers: "No: " + numbers.astype(str), "string")
    return load(spark, sf_dir, "orders").select("o_orderkey", label("o_orderkey").alias("label"))


@query
def map_record(spark, sf_dir):
    return mapping.as_record(load(spark, sf_dir, "orders"), "o_orderkey")


BRACKETS = [-500.0, 0.0, 250.0, 1000.0, 5000.0]


@query
def map_partitions(spark, sf_dir):
    """Brackets of uneven width, looked up for whole batches in a table that each task makes once."""

    def bracket(bounds, batch):
        return batch.assign(bracket=np.searchsorted(bounds, batch["c_acctbal"], side="right").astype("int32"))

    people = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return mapping.map_with_setup(
        people, lambda: np.array(BRACKETS), bracket, "c_custkey bigint, c_acctbal double, bracket int"
    )


@query
def task_writer(spark, sf_dir):
    """Rows that each task has written by itself, read back from the shared folder."""
    folder = work_folder(spark, "task_writer")

    def write(number, batches):
        system, path = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        with pq.ParquetWriter(f"{path}/part-{number:05d}.parquet", SCHEMA, filesystem=system) as writer:
            for batch in batches:
                writer.write_batch(batch.cast(SCHEMA))

    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    mapping.for_each_task(orders, write)
    return spark.read.schema("o_orderkey bigint, o_orderstatus string").parquet(folder)


SCHEMA = pa.schema([("o_orderkey", pa.int64()), ("o_orderstatus", pa.string())])


@query
def map_frames(spark, sf_dir):
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    debts = lambda batch: batch.assign(c_acctbal=batch["c_acctbal"].clip(upper=0.0)).rename(columns={"c_acctbal": "debt"})
    return mapping.map_frames(people, debts, "c_custkey bigint, debt double")


@query
def keyed_reduce(spark, sf_dir):
    """Clicks have no value here: users with nothing else have none either."""
    value = F.when(F.col("event_type") != "click", F.col("value")).alias("value")
    values = load(spark, sf_dir, "events").select("user_id", value)
    return counting.reduce_by_key(values, ["user_id"], "value", lambda series: series.max())


# --- views, catalog and file formats -----------------------------------------------------


def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query
def sql_view(spark, sf_dir):
    return catalog.select_all(spark, catalog.session_view(load(spark, sf_dir, "part"), fresh_name("part")))


@query
def sql_shared_view(spark, sf_dir):
    name = catalog.shared_view(load(spark, sf_dir, "supplier"), fresh_name("supplier"))
    return catalog.select_all(spark, name)


@query
def catalog_table(spark, sf_dir):
    name = fresh_name("orders")
    catalog.save_catalog_table(load(spark, sf_dir, "orders"), name, work_folder(spark, "catalog"))
    return catalog.select_all(spark, name)


@query
def csv_text_columns(spark, sf_dir):
    """CSV with a header and no schema: every column is text."""
    folder = work_folder(spark, "csv_text_columns")
    files.write_table(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), folder, format="csv", header=True)
    return files.read_csv(spark, folder)


@query
def csv_typed(spark, sf_dir):
    folder = work_folder(spark, "csv_typed")
    people = load(spark, sf_dir, "customer")
    files.write_table(people, folder, format="csv", header=True)
    return files.read_csv(spark, folder, people.schema)


@query
def csv_options(spark, sf_dir):
    folder = work_folder(spark, "csv_options")
    note = F.concat(F.lit('says "'), F.col("o_orderpriority"), F.lit('" | ok'))
    amount = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", note.alias("note"), amount.alias("amount"), F.to_date("o_orderdate").alias("day")
    )
    settings = {"sep": "|", "escape": "\\", "nullValue": "none", "dateFormat": "dd.MM.yyyy"}
    files.write_table(orders, folder, format="csv", header=True, **settings)
    return files.read_csv(spark, folder, orders.schema, **settings).withColumn("day", F.col("day").cast("string"))


def rough_csv(spark: SparkSession, sf_dir: str, mode: str, **options) -> DataFrame:
    folder = work_folder(spark, f"csv_{mode}")
    files.write_table(rough_orders(spark, sf_dir), folder, format="csv", header=True)
    return files.read_csv(spark, folder, ORDER_SCHEMA, mode, **options)


@query
def csv_permissive(spark, sf_dir):
    return rough_csv(spark, sf_dir, "permissive")


@query
def csv_dropmalformed(spark, sf_dir):
    return rough_csv(spark, sf_dir, "dropmalformed")


@query
def csv_quarantine(spark, sf_dir):
    """The dirty records of a permissive read, as they stand in the file."""
    read = rough_csv(spark, sf_dir, "permissive", quarantine=True)
    return read.where(F.col(files.CORRUPT).isNotNull()).select("o_orderkey", F.col(files.CORRUPT).alias("record"))


@query
def json_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "json")
    documents = load(spark, sf_dir, "documents")
    files.write_table(documents, folder, format="json")
    return files.read_table(spark, folder, "json", documents.schema)


@query
def orc_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "orc")
    files.write_table(load(spark, sf_dir, "lineitem"), folder, format="orc")
    return files.read_table(spark, folder, "orc")


@query
def part_files(spark, sf_dir):
    """The part files of a partitioned table, read file by file with the columns of their folders."""
    folder = work_folder(spark, "part_files")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_table(shaping.balanced(orders, "o_orderstatus"), folder, partition_by=["o_orderstatus"])
    return files.read_part(spark, f"{folder}/o_orderstatus=*/*.parquet", folder)


@query
def write_modes(spark, sf_dir):
    """Overwrite, append, and two writes that the existing table turns away."""
    folder = work_folder(spark, "write_modes")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for mode in ("overwrite", "append", "ignore"):
        files.write_table(orders, folder, mode)
    try:
        files.write_table(orders, folder, "errorifexists")
    except AnalysisException:
        pass
    return files.read_table(spark, folder)


# --- streams -----------------------------------------------------------------------------


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.with_event_time(stream(spark, sf_dir, "events"), "ts")


WINDOW_KEYS = ["window_start", "window_end"]


@query
def stream_wc(spark, sf_dir):
    with results.stream_settings(spark):
        documents = stream(spark, sf_dir, "documents").select("text")
        counts = streams.running_word_count(documents, "text", SPACE_OR_NEWLINE)
        return results.run_to_table(counts, work_folder(spark, "stream_wc"), "complete")


@query
def tumble_5m(spark, sf_dir):
    with results.stream_settings(spark):
        counts = events.windowed_count(timed_events(spark, sf_dir), "ts", ["event_type"], "5 minutes")
        return results.run_to_table(events.flat_windows(counts), work_folder(spark, "tumble_5m"), "complete")


@query
def tumble_10m_append(spark, sf_dir):
    with results.stream_settings(spark):
        counts = events.windowed_count(timed_events(spark, sf_dir), "ts", ["event_type"], "10 minutes", "5 minutes")
        return results.run_to_table(events.flat_windows(counts), work_folder(spark, "tumble_10m_append"), "append")


@query
def tumble_10m_update(spark, sf_dir):
    with results.stream_settings(spark):
        counts = events.windowed_count(timed_events(spark, sf_dir), "ts", ["event_type"], "10 minutes", "5 minutes")
        keys = [*WINDOW_KEYS, "event_type"]
        return results.run_to_table(events.flat_windows(counts), work_folder(spark, "tumble_10m_update"), "update", keys)


@query
def tumble_5m_update(spark, sf_dir):
    with results.stream_settings(spark):
        counts = events.windowed_count(timed_events(spark, sf_dir), "ts", ["event_type"], "5 minutes", "10 minutes")
        keys = [*WINDOW_KEYS, "event_type"]
        return results.run_to_table(events.flat_windows(counts), work_folder(spark, "tumble_5m_update"), "update", keys)


@query
def timed_words(spark, sf_dir):
    """Events as lines ``timestamp,word``, parsed back and counted in windows."""
    with results.stream_settings(spark):
        source = stream(spark, sf_dir, "events")
        lines = source.select(F.concat_ws(",", F.col("ts").cast("string"), "event_type").alias("value"))
        counts = events.flat_windows(streams.windowed_word_count(lines))
        return results.run_to_table(counts, work_folder(spark, "timed_words"), "complete")


@query
def stream_static(spark, sf_dir):
    with results.stream_settings(spark):
        profiles = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        enriched = streams.hourly_actions(
            timed_events(spark, sf_dir), profiles, "user_id", "event_type", "ts", "c_custkey"
        )
        keys = [*WINDOW_KEYS, "user_id", "event_type"]
        return results.run_to_table(events.flat_windows(enriched), work_folder(spark, "stream_static"), "update", keys)


def clicks_and_views(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    time = event_time(source, "ts")
    clicks = source.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), time.alias("click_ts")
    )
    views = source.where(F.col("event_type") == "view").select(
        F.col("user_id").alias("view_user"), F.col("event_id").alias("view_id"), time.alias("view_ts")
    )
    return clicks, views


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as timestamps without a zone."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


@query
def stream_stream(spark, sf_dir):
    folder = work_folder(spark, "stream_stream")
    with results.stream_settings(spark):
        clicks, _ = clicks_and_views(stream(spark, sf_dir, "events"))
        _, views = clicks_and_views(stream(spark, sf_dir, "events"))
        pairs = streams.actions_after_posting(
            clicks,
            views,
            "user_id",
            "view_user",
            "click_ts",
            "view_ts",
            salts=2,
        )
        return results.run_to_table(zoneless(pairs), folder, "append")


def arrivals_by_day(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[str]:
    """The events of the first day as files in a folder, then those of the other days beside them."""
    rows = load(spark, sf_dir, "events")
    day = event_time(rows, "ts").cast("date")
    first = F.broadcast(rows.agg(F.min(day).alias("first")))
    for later in (False, True):
        part = rows.join(first, day > F.col("first") if later else day == F.col("first")).drop("first")
        part.write.mode("append").parquet(folder)
        yield folder


@query
def stream_static_fresh(spark, sf_dir):
    """Profiles that become more between two arrivals of events; each micro-batch sees those there are."""
    folder = work_folder(spark, "stream_static_fresh")
    profiles = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    known = lambda: spark.read.schema(profiles.schema).parquet(f"{folder}/profiles")
    join = lambda batch, side: joins.with_attributes(batch, side, "user_id", "c_custkey")
    with results.stream_settings(spark):
        for odd, _ in enumerate(arrivals_by_day(spark, sf_dir, f"{folder}/events")):
            profiles.where(F.col("c_custkey") % 2 == odd).write.mode("append").parquet(f"{folder}/profiles")
            rows = inputs.with_event_time(inputs.table_stream(spark, f"{folder}/events"), "ts")
            counts = events.flat_windows(events.windowed_count(rows, "ts", ["user_id", "event_type"], "1 hour", "30 minutes"))
            keys = [*WINDOW_KEYS, "user_id", "event_type"]
            running, table = results.start_with_static(counts, known, join, folder, "update", keys)
            results.wait_for_all(running)
    return table.read()


@query
def join_state(spark, sf_dir):
    """How many rows a join of two streams keeps after the first day, and after a restart with the other days."""
    folder, found = work_folder(spark, "join_state"), []
    with results.stream_settings(spark, whole_state=True):
        for run, _ in enumerate(arrivals_by_day(spark, sf_dir, f"{folder}/events"), 1):
            clicks, _ = clicks_and_views(inputs.table_stream(spark, f"{folder}/events"))
            _, views = clicks_and_views(inputs.table_stream(spark, f"{folder}/events"))
            pairs = streams.actions_after_posting(clicks, views, "user_id", "view_user", "click_ts", "view_ts", salts=2)
            results.run_to_table(zoneless(pairs), folder, "append")
            for side in ("left", "right"):
                kept = state_rows(spark, f"{folder}/checkpoint", joinSide=side)
                found.append((run, side, kept.count()))
    return spark.createDataFrame(found, "run int, side string, kept long")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.as_envelope(stream(spark, sf_dir, "events"), "usage", "event_type", "value", "event_id", "ts")


@query
def keyed_avg(spark, sf_dir):
    """Average per message key; the table and the topic are written from one reading of the messages."""
    with results.stream_settings(spark):
        messages = event_messages(spark, sf_dir)
        running, clients, _ = streams.start_client_averages(
            messages, work_folder(spark, "keyed_avg"), trigger=results.ONCE, as_type=MONEY
        )
        results.wait_for_all(running)
    return clients.read().withColumn("average_value", F.round("average_value", 6))


@query
def topic_frame(spark, sf_dir):
    """What the topic receives: key and value as text."""
    with results.stream_settings(spark):
        averages = events.keyed_average(event_messages(spark, sf_dir), as_type=MONEY)
        messages = topics.as_messages(averages.withColumn("average", F.round("average", 4)), "key", "average")
        running, sent = topics.start_topic_files(messages, work_folder(spark, "topic_frame"), trigger=results.ONCE)
        results.wait_for_all(running)
    return sent.read()


@query
def usage_pct(spark, sf_dir):
    with results.stream_settings(spark):
        telemetry = stream(spark, sf_dir, "lineitem").select(
            "l_returnflag",
            F.col("l_extendedprice").alias("total"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("free"),
        )
        averages = events.keyed_average(events.usage_messages(telemetry, "l_returnflag", "total", "free"))
        running, view = results.start_view(averages, work_folder(spark, "usage_pct"))
        results.wait_for_all(running)
    return spark.table(view).select(F.col("key").alias("l_returnflag"), F.round("average", 4).alias("usage"))


@query
def stream_passthrough(spark, sf_dir):
    """Messages appended to files as they are."""
    folder = work_folder(spark, "stream_passthrough")
    with results.stream_settings(spark):
        messages = event_messages(spark, sf_dir).select(
            F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset"
        )
        results.wait_for_all(results.start_files(messages, f"{folder}/out", f"{folder}/checkpoint"))
    return files.read_table(spark, f"{folder}/out")


LATE = "late_words"


def late_run(spark: SparkSession, sf_dir: str, metrics: BatchMetrics | None = None) -> results.ResultTable:
    """Three files in order of arrival, the last with lines of the first day: these come too late."""
    folder = work_folder(spark, LATE)
    time = event_time(load(spark, sf_dir, "events"), "ts")
    source = load(spark, sf_dir, "events").select(
        time.cast("date").alias("day"), F.concat_ws(",", time.cast("string"), "event_type").alias("value")
    )
    first = F.broadcast(source.agg(F.min("day").alias("first")))
    arrivals = [source.join(first, F.expr(when)).select("value") for when in ("day = first", "day > first", "day = first")]
    with results.stream_settings(spark):
        for rows in arrivals:
            # One run after the other, so that each arrival is a micro-batch of its own.
            rows.write.mode("append").text(f"{folder}/in")
            lines = inputs.line_stream(spark, f"{folder}/in")
            counts = events.flat_windows(streams.windowed_word_count(lines, "10 minutes", "5 minutes", observed=LATE))
            running, table = results.start_table(counts, folder, "update", [*WINDOW_KEYS, "word"])
            results.wait_for_all(running)
            if metrics:
                metrics.wait_for(running)
    return table


@query
def late_words(spark, sf_dir):
    return late_run(spark, sf_dir).read()


@query
def late_rows(spark, sf_dir):
    """How many of the lines of `late_words` were dropped, by the stream's own metrics."""
    metrics = BatchMetrics(spark, work_folder(spark, "late_metrics"))
    try:
        table = late_run(spark, sf_dir, metrics)
    finally:
        metrics.stop()
    return rows_dropped_late(metrics.read(), f"{LATE}.given", table.read())


@query
def stream_every_second(spark, sf_dir):
    """A stream under a timed trigger, ended when it has taken all input."""
    with results.stream_settings(spark):
        rows = stream(spark, sf_dir, "orders")
        counts = counting.count_by(rows, "o_orderstatus", name="count")
        running, view = results.start_view(
            counts, work_folder(spark, "stream_every_second"), trigger={"processingTime": "1 second"}
        )
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    return spark.table(view)


@query
def cleaning_job(spark, sf_dir):
    """The cleaning job as one chain: one row per customer of each order, masked, renamed, a row per word of its name."""
    orders = load(spark, sf_dir, "orders").select("o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    both = cleaning.one_per_key(people.join(orders, "c_custkey"), ["c_custkey"], ["c_name"])
    masked = staff.masked_records(both, "c_custkey", "c_name", "c_nationkey", {"c_mktsegment": "segment"}, salt="brook")
    words_ = masked.withColumn("parts", F.split("c_name", "#")).drop("c_name")
    return shaping.unfold(words_, "parts", "part")


@query
def stream_restart(spark, sf_dir):
    """The same stream started twice on one checkpoint: the second run adds nothing."""
    folder = work_folder(spark, "stream_restart")
    with results.stream_settings(spark):
        for _ in range(2):
            rows = stream(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
            table = results.run_to_table(rows, folder, "append")
    return table


@query
def stream_csv(spark, sf_dir):
    """CSV files of a watched folder, counted per hour."""
    folder = work_folder(spark, "stream_csv")
    form = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    source = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    files.write_table(source, f"{folder}/in", format="csv", header=True, timestampNTZFormat=form)
    schema = T.StructType().add("event_id", "long").add("ts", "timestamp").add("event_type", "string")
    with results.stream_settings(spark):
        rows = inputs.csv_stream(spark, f"{folder}/in", schema, timestampFormat=form)
        counts = events.flat_windows(events.windowed_count(rows, "ts", ["event_type"], "1 hour"))
        return results.run_to_table(counts, folder, "complete")


@query
def stream_lines(spark, sf_dir):
    """Text files of a watched folder, taken a few at a time: words of all lines so far."""
    folder = work_folder(spark, "stream_lines")
    line_rows(texts(spark, sf_dir), "text").write.text(f"{folder}/in")
    with results.stream_settings(spark):
        counts = streams.running_word_count(inputs.line_stream(spark, f"{folder}/in", "\n", max_files=4))
        return results.run_to_table(counts, folder, "update", ["word"])
