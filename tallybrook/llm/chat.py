"""Chat formatting: logged snapshots that a longer conversation continues are dropped, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import stored

# Turns of a conversation that one task takes in order; longer conversations go on in further chunks.
CHUNK = 256


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, a, b, rows): two 64-bit digests per turn number of a conversation.

    A row logged twice counts once; rows under one turn number form one turn. Rows are reduced to
    their digests before any of them moves.
    """
    texts = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    rows = conversations.select(
        "conv_id", "turn", F.xxhash64(F.lit(1), *texts).alias("a"), F.xxhash64(F.lit(2), *texts).alias("b")
    ).distinct()
    return rows.groupBy("conv_id", "turn").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.count("*").alias("rows")
    )


def prefix_digests(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, turns, of, rows, a, b): for each turn the digest of the conversation up to it.

    A digest is the exclusive-or of its turns' digests, each of which holds the turn's number, so
    chunks of a long conversation are digested side by side and put together by one row each.
    """
    turns = turn_digests(conversations).withColumn("chunk", F.floor(F.col("turn") / chunk))
    running = (
        Window.partitionBy("conv_id", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = {"a": F.bit_xor("a"), "b": F.bit_xor("b"), "turns": F.count("*"), "rows": F.sum("rows")}
    inside = stored(
        turns.select("conv_id", "chunk", *(f.over(running).alias(c) for c, f in sums.items())), "turn-digests"
    )
    last = inside.groupBy("conv_id", "chunk").agg(F.max_by(F.struct("a", "b", "turns", "rows"), "turns").alias("c"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")
    bases = last.select(
        F.col("conv_id").alias("id"),
        F.col("chunk").alias("part"),
        F.coalesce(F.bit_xor("c.a").over(before), F.lit(0)).alias("a0"),
        F.coalesce(F.bit_xor("c.b").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("c.turns").over(before), F.lit(0)).alias("turns0"),
        F.sum("c.turns").over(every).alias("of"),
        F.sum("c.rows").over(every).alias("all_rows"),
    )
    here = F.col("conv_id").eqNullSafe(F.col("id")) & F.col("chunk").eqNullSafe(F.col("part"))
    return inside.join(bases, here).select(
        "conv_id",
        (F.col("turns") + F.col("turns0")).alias("turns"),
        "of",
        F.col("all_rows").alias("rows"),
        F.col("a").bitwiseXOR(F.col("a0")).alias("a"),
        F.col("b").bitwiseXOR(F.col("b0")).alias("b"),
    )


def maximal_conversations(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, turns, rows) of the conversations that no longer one begins with.

    Among conversations alike in all turns the smallest id stays. Both sides of the anti-join
    are distinct digests, so a first turn or a conversation that many share is one row.
    """
    prefixes = stored(prefix_digests(conversations, chunk), "prefixes")
    key = ["a", "b", "turns"]
    whole = prefixes.where("turns = of").groupBy(*key).agg(F.min(F.struct(F.isnull("conv_id"), "conv_id", "rows")).alias("m"))
    longer = prefixes.where("turns < of").select(*key).distinct()
    return whole.join(longer, key, "left_anti").select("m.conv_id", "turns", "m.rows")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n")
    )


def format_chats(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, n_turns, text): the maximal conversations, rendered turn by turn.

    ``conversations`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left
    out. Turns are ordered by number, then role and text, null first; a null conversation id is an
    id like others, a null role is rendered as ``unknown``, a null text as nothing. ``n_turns``
    counts rows, those logged twice once. No rows, no conversations.
    """
    kept = stored(maximal_conversations(conversations, chunk), "maximal").select(
        F.col("conv_id").alias("id"), F.col("rows").alias("n_turns")
    )
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.join(kept, F.col("conv_id").eqNullSafe(F.col("id")))
    turns = F.array_sort(F.array_distinct(F.collect_list(F.struct("turn", "role", "text"))))
    whole = rows.groupBy("conv_id", "n_turns").agg(turns.alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: rendered_turn(t["role"], t["text"])), "")
    return whole.select("conv_id", "n_turns", text.alias("text"))


CHAT_SQL = """
WITH logged AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
turns AS (
  SELECT conv_id, turn, list({'role': role, 'text': text} ORDER BY role NULLS FIRST, text NULLS FIRST) AS said,
         COUNT(*) AS n FROM logged GROUP BY conv_id, turn),
whole AS (
  SELECT conv_id, list({'turn': turn, 'said': said} ORDER BY turn NULLS FIRST) AS turns, SUM(n) AS n_turns, COUNT(*) AS k
  FROM turns GROUP BY conv_id),
firsts AS (SELECT MIN(conv_id) AS conv_id, turns, k, ANY_VALUE(n_turns) AS n_turns FROM whole GROUP BY turns, k),
prefixes AS (SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, k)) AS i FROM whole)),
kept AS (SELECT conv_id, n_turns FROM firsts ANTI JOIN prefixes USING (turns))
SELECT l.conv_id, CAST(ANY_VALUE(n_turns) AS BIGINT) AS n_turns,
       string_agg('<|im_start|>' || COALESCE(role, 'unknown') || chr(10) || COALESCE(text, '') || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
FROM logged l JOIN kept ON l.conv_id IS NOT DISTINCT FROM kept.conv_id
GROUP BY l.conv_id
"""
