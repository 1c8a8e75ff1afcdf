"""Sharding by a two-pass external shuffle: scatter into memory-sized buckets, shuffle each bucket, write it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import rows_held, stored

SHARDS = 40
# Text bytes that a bucket holds on average; one task keeps a few buckets in memory.
BUCKET_BYTES = 8 << 20
SEED = 20
# Buckets whose counts are summed together before the sums of such groups.
BUCKETS_PER_GROUP = 4096


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def shuffled_buckets(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """The rows in random order as a stored table of (bucket, place, row).

    First pass: a seeded hash scatters the rows evenly over so many buckets that each fits in
    memory. Rows alike in all columns part too, since the hash also takes the row's position in
    its input. Second pass: each bucket is put in a fixed order, shuffled by Fisher and Yates'
    method (``shuffle`` on an array), and written.
    """
    held = rows_held(docs)
    text = F.col("row.text")
    total = held.agg(F.sum(record_size(text)).alias("n")).first().n or 0
    buckets = max(1, -(-total // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col("row.doc_id"), text, F.monotonically_increasing_id())
    scattered = held.select("row", key.alias("key"))
    scattered = scattered.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("long"))
    lists = (
        scattered.repartition(int(buckets), "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("key", "row"))).alias("rows"))
    )
    return stored(
        lists.select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "item")).select(
            "bucket", F.col("place").cast("long").alias("place"), F.col("item.row").alias("row")
        ),
        "buckets",
    )


def shards(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Rows in random order, dealt into ``shards`` runs: (row, shard, slot).

    The buckets one after another give each row a position; shards are equal runs of positions,
    so their row counts differ by one at most, and ``slot`` counts from 0 without gaps. A shard
    takes whole neighbouring buckets, so writing it needs no further shuffle. ``docs`` needs
    ``doc_id`` and ``text``, null or not; all columns stay inside ``row``. Repeated rows, such
    with equal texts and such without id or text are rows like others. No rows, no shards.
    """
    placed = shuffled_buckets(docs, bucket_bytes, seed)
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("part", F.floor(F.col("bucket") / BUCKETS_PER_GROUP)), "bucket-counts")
    parts = counts.groupBy("part").agg(F.sum("n").alias("of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("earlier_parts"))
    inside = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(parts, "part").select(
        "bucket", (F.col("earlier_parts") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first")
    )
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    starts = stored(starts, "bucket-starts")
    position = F.col("first") + F.col("place")
    dealt = placed.join(starts, "bucket").select("row", position.alias("at"))
    shard = F.expr(f"(at * {shards}L) div {max(rows, 1)}L").cast("int")
    return dealt.select("row", shard.alias("shard"), "at").select(
        "row", "shard", (F.col("at") - F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=k`` per shard, rows with their ``slot``; the columns of the documents in ``row``."""
    sharded.write.partitionBy("shard").parquet(path)
