"""Packing by minimum bin slack: documents as token pieces, placed in windows with as little padding as possible."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import binary_column, map_batches, slices, spread, stored, tokenizer_for, vocabulary_file, with_end

WINDOW = 4096
END_ID = 2
# Text tokenized at once: the more, the more memory for each worker, but hardly less time.
TOKENIZED_BYTES = 1 << 20
# Rows of three numbers that a broadcast may have; beyond it the pieces are shuffled by length and task.
BROADCAST_STARTS = 1_000_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, task long, place long"
)


def token_pieces(
    docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """The token ids of each document and ``end_id``, cut after each full window.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. A null or empty text is
    the end token alone; repeated rows are documents of their own; a null ``doc_id`` stays null.
    ``ids`` holds little-endian unsigned 32-bit ids; ``place`` numbers the pieces of one length
    within a task. An empty table has no pieces.
    """
    path = vocabulary or vocabulary_file()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_for(path)
        task = TaskContext.get().partitionId()
        used = np.zeros(window + 1, np.int64)
        for batch in batches:
            for part, text in slices(batch, batch.column("text"), TOKENIZED_BYTES):
                ids, tokens = with_end(*tokenizer.encode(text), end_id)
                pieces = -(-tokens // window)
                doc = np.repeat(np.arange(len(tokens)), pieces)
                start = spread(np.zeros(len(tokens), np.int64), pieces) * window
                length = np.minimum(window, tokens[doc] - start)
                at = np.cumsum(length) - length
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run = length[order]
                place = np.empty(len(run), np.int64)
                place[order] = used[run] + np.arange(len(run)) - np.searchsorted(run, run)
                used += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc)).cast(pa.int64()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crc, pa.int64()),
                        pa.array(tokens[doc]),
                        binary_column(ids, at, length),
                        pa.array(np.full(len(run), task)),
                        pa.array(place),
                    ],
                    names=[x.split()[0] for x in PIECES.split(", ")],
                )

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, PIECES)


def fullest_window(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """Which lengths fill one window closest to capacity, the longest of all among them.

    Bit ``t`` of a Python integer says that some choice of the lengths seen so far sums to ``t``.
    Counts go in by powers of two, and the states before each are kept to trace back the choice.
    """
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    longest = lengths[0]
    room, full = capacity - longest, (1 << (capacity - longest + 1)) - 1
    sums, steps = 1, []
    for n in lengths:
        if n > room:
            continue
        left, part = min(counts[n] - (n == longest), room // n), 1
        while left > 0:
            take = min(part, left)
            steps.append((n, take, sums))
            sums |= (sums << (n * take)) & full
            left, part = left - take, part * 2
        if sums >> room & 1:
            break
    target = sums.bit_length() - 1
    chosen = {longest: 1}
    for n, take, before in reversed(steps):
        if not before >> target & 1:
            chosen[n] = chosen.get(n, 0) + take
            target -= n * take
    return sorted(chosen.items(), reverse=True)


def minimum_slack_plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(lengths with their multiplicities, how many windows are filled so), until no piece is left.

    A choice is repeated while its pieces last, so the plan's size depends on the capacity and
    not on the number of pieces.
    """
    left, plan = dict(counts), []
    while left:
        chosen = fullest_window(left, capacity)
        times = min(left[n] // k for n, k in chosen)
        plan.append((chosen, times))
        for n, k in chosen:
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def _lookup(plan: list[tuple[list[tuple[int, int]], int]], window: int) -> dict[str, np.ndarray]:
    """Per length and rank range: its first sequence, its offset there, and how many lie side by side."""
    ranked: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in plan:
        offset = 0
        for n, k in chosen:
            first = ranked.get(n, 0)
            rows.append((n, first, k, sequence, offset))
            ranked[n] = first + k * times
            offset += n * k
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "side", "sequence", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Give each piece of a stored table its ``sequence_id`` and ``offset``; no sequence exceeds ``window``.

    Lengths are counted over all pieces; the counts, at most ``window`` of them, are all that
    the driver sees, and the plan made from them is as bounded. A piece finds its window by
    its length and its rank among the pieces of that length: the counts of earlier tasks plus
    its place in its own, so no piece is sorted and a frequent length has no task of its own.
    Pieces alike in all columns are placed each for itself. ``pieces`` must be a table that
    reads the same again, such as ``stored(token_pieces(docs))``.
    """
    spark = pieces.sparkSession
    by_task = pieces.groupBy("length", "task").agg(F.max("place").alias("last"))
    by_task = stored(by_task.select("length", "task", (F.col("last") + 1).alias("n")), "lengths")
    counts = {int(r.length): int(r.n) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    lookup = spark.sparkContext.broadcast(_lookup(minimum_slack_plan(counts, window), window))
    names = [c for c in pieces.columns if c not in ("task", "place")]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = lookup.value
        key = plan["length"] * (1 << 40) + plan["first"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.searchsorted(key, length * (1 << 40) + rank, side="right") - 1
            inside = rank - plan["first"][row]
            side = plan["side"][row]
            sequence = plan["sequence"][row] + inside // side
            offset = plan["offset"][row] + inside % side * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    earlier = F.sum("n").over(_before())
    starts = by_task.select("length", "task", (earlier - F.col("n")).alias("base"))
    small = by_task.count() <= BROADCAST_STARTS
    starts = F.broadcast(starts) if small else starts.hint("shuffle_hash")
    ranked = pieces.join(starts, ["length", "task"]).select(*names, (F.col("base") + F.col("place")).alias("rank"))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    return map_batches(ranked, place, schema)


def _before():
    from pyspark.sql import Window

    return Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, 0)


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Documents as packed pieces with their ids: one row per piece, ready to be laid out by sequence and offset."""
    return pack(stored(token_pieces(docs, vocabulary, window, end_id), "pieces"), window)


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Tokens, sequences and padding: up to the window, none where the fill is a power of two."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    power = F.bit_count("fill") == 1
    return fill.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("fill"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(power, 0).otherwise(window - F.col("fill"))), F.lit(0)).alias("padding"),
    )
