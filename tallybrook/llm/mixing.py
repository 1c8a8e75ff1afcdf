"""Mixing sources to target weights: repetition rates per source, whole copies and one seeded draw for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import WORD, rows_held, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
# A table of sources is broadcast up to this many rows; beyond it the join is shuffled with salted sources.
BROADCAST_SOURCES = 10_000
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest of the seed, the id and the text."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``target`` for each row of (source, source_size).

    Sources in order of their code points, null last, take the weights in turn. ``share`` of all
    sizes is dealt out by weight; no target exceeds ``most`` times its source's size, and what
    that cuts off is dealt out again among the others. Sorted by size over weight, the sources
    that stop at their limit come first, so running sums settle it at once. There is one row
    per source here, never one per document. An empty source has target 0.
    """
    if share > most:
        raise ValueError("the share cannot exceed what the sources may give")
    numbered = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("k") % len(weights) + 1))
    ordered = Window.orderBy((F.col("source_size") * most / F.col("weight")), "k")
    until, all_rows = ordered.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sums = weighed.select(
        "source",
        "source_size",
        "weight",
        (F.col("source_size") * most).alias("limit"),
        (F.sum("source_size").over(all_rows) * F.lit(share)).alias("total"),
        F.coalesce(F.sum(F.col("source_size") * most).over(until), F.lit(0)).alias("limits_before"),
        F.sum("weight").over(all_rows).alias("weights"),
        F.coalesce(F.sum("weight").over(until), F.lit(0)).alias("weights_before"),
    )
    level = (F.col("total") - F.col("limits_before")) * F.col("weight") / (F.col("weights") - F.col("weights_before"))
    stopped = sums.withColumn("stopped", F.col("limit") <= level)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("stopped"), F.col("limit"))).over(all_rows), F.lit(0))
    open_weights = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(all_rows)
    return stopped.select(
        "source",
        "source_size",
        F.when(F.col("stopped"), F.col("limit").cast("double"))
        .otherwise(rest * F.col("weight") / open_weights)
        .alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """How often each document is taken: (row, size, source_size, target, copies), all documents.

    A source's rate is its target over its size. A document is taken floor(rate) times, and once
    more if its draw, made from the seed, its id and its text, is below the fraction; so a run
    repeats itself, and rows alike in id and text share one draw. ``docs`` needs ``doc_id``,
    ``text`` and ``source``; all its columns stay inside ``row``. Sizes are words unless a
    column is given; a null text has none, a null source is a source, no document is left out.
    """
    held = rows_held(docs)
    text, doc_id, source = F.col("row.text"), F.col("row.doc_id"), F.col("row.source")
    sized = held.select("row", (word_count(text) if size is None else size).alias("size"))
    sizes = sized.groupBy(source.alias("source")).agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = (unit_draw(doc_id, text, seed) < rate - F.floor(rate)).cast("int")
    same = F.col("of").eqNullSafe(F.col("source"))
    if targets.count() <= BROADCAST_SOURCES:
        joined = sized.withColumn("of", source).join(F.broadcast(targets), same)
    else:
        salted = sized.withColumns({"of": source, "salt": F.pmod(F.xxhash64(doc_id, text), F.lit(SALTS))})
        copied = targets.withColumn("at", F.expr(f"explode(sequence(0L, {SALTS - 1}L))"))
        joined = salted.join(copied, same & (F.col("salt") == F.col("at")))
    return joined.select("row", "size", "source_size", "target", (F.floor(rate) + drawn).cast("int").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``mix_plan`` as often as it is taken, with the columns of ``docs``."""
    plan = mix_plan(docs, **options)
    return (
        plan.where("copies > 0")
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
        .select("row.*")
    )


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || COALESCE(text, '')),
              1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
sizes AS (SELECT source, SUM(size) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, k,
         CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM sizes)),
sums AS (
  SELECT source, source_size, weight, source_size * 2 AS cap,
         SUM(source_size) OVER () * 1.5::DOUBLE AS total,
         COALESCE(SUM(source_size * 2) OVER before, 0) AS caps_before,
         SUM(weight) OVER () AS weights,
         COALESCE(SUM(weight) OVER before, 0) AS weights_before
  FROM weighed
  WINDOW before AS (ORDER BY source_size * 2 / weight::DOUBLE, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stops AS (
  SELECT *, cap <= (total - caps_before::DOUBLE) * weight::DOUBLE / (weights - weights_before)::DOUBLE AS stopped
  FROM sums),
targets AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN cap::DOUBLE
              ELSE (total - COALESCE(SUM(CASE WHEN stopped THEN cap END) OVER (), 0)::DOUBLE) * weight::DOUBLE
                   / (SUM(CASE WHEN NOT stopped THEN weight END) OVER ())::DOUBLE END AS target
  FROM stops),
rated AS (
  SELECT doc_id, size, source_size, target, draw,
         CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
