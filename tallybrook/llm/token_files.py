"""Token output: best-fit-decreasing packing of ids into fixed windows, written as matrices with segment bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import binary_column, map_batches, slices, spread, tokenizer_for, vocabulary_file, with_end
from tallybrook.session import work_folder

WINDOW = 2048
END_ID = 2
# Distinct words whose token ids a worker remembers.
MEMO_WORDS = 500_000
# Tokens that a task gathers before it packs and writes them.
GROUP_TOKENS = 1 << 20

ROWS = (
    "sequence_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>,"
    " doc_ids array<long>, starts array<long>"
)


class Capacities:
    """Bins by what is left in them; a segment tree finds the fullest one with room enough."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        at = self.size + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The smallest room of ``least`` or more and a bin that has it, which is taken out."""
        at = self.size + least
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at *= 2
                if not self.count[at]:
                    at += 1
        room = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """The bin of each piece and the number of bins: longest first, each into the fullest bin with room."""
    bins = np.empty(len(lengths), np.int64)
    free, used = Capacities(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = free.take(n) if n < window else None
        if found is None:
            room, number = window, used
            used += 1
        else:
            room, number = found
        bins[i] = number
        if room > n:
            free.put(room - n, number)
    return bins, used


def packed_rows(
    ids: np.ndarray, tokens: np.ndarray, doc_ids: list[int | None], window: int, pad_id: int, first: int
) -> pa.RecordBatch:
    """A group of documents as rows of the matrix, full windows first."""
    pieces = -(-tokens // window)
    doc = np.repeat(np.arange(len(tokens)), pieces)
    start = spread(np.zeros(len(tokens), np.int64), pieces) * window
    length = np.minimum(window, tokens[doc] - start)
    source = np.cumsum(length) - length
    bins, n = best_fit_decreasing(length, window)
    order = np.lexsort((np.arange(len(bins)), -length, bins))
    bins, doc, start, length, source = bins[order], doc[order], start[order], length[order], source[order]
    ends = np.cumsum(length)
    first_of_bin = np.searchsorted(bins, np.arange(n + 1))
    before = np.concatenate([[0], ends])[first_of_bin[:-1]]
    offset = ends - length - before[bins]
    at = bins * window + offset
    matrix, positions = np.full(n * window, pad_id, "<u4"), np.zeros(n * window, "<u2")
    to = spread(at, length)
    matrix[to] = ids[spread(source, length)]
    positions[to] = spread(np.zeros(len(length), np.int64), length)
    fill = np.bincount(bins, weights=length, minlength=n).astype(np.int64)
    segments = np.diff(first_of_bin)
    bounds = np.insert(offset + length, first_of_bin[:-1], 0)
    bound_offsets = first_of_bin + np.arange(n + 1)
    lists = pa.array(first_of_bin, pa.int32())
    rows = np.arange(n)
    assert segments.sum() == len(doc)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(first + rows),
            pa.array(fill, pa.int32()),
            binary_column(matrix, rows * window, np.full(n, window)),
            binary_column(positions, rows * window, np.full(n, window)),
            pa.ListArray.from_arrays(pa.array(bound_offsets, pa.int32()), pa.array(bounds, pa.int32())),
            pa.ListArray.from_arrays(lists, pa.array([doc_ids[i] for i in doc.tolist()], pa.int64())),
            pa.ListArray.from_arrays(lists, pa.array(start, pa.int64())),
        ],
        names=["sequence_id", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "starts"],
    )


def token_matrix(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    pad_id: int = 0,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per window: ids and positions as little-endian binary rows of a matrix, and its segments.

    ``ids`` are unsigned 32-bit, padded with ``pad_id`` beyond ``n_tokens``; ``positions``, unsigned
    16-bit, start from 0 again in each segment; ``cu_seqlens`` has the segments' bounds, from 0 to
    ``n_tokens``; ``doc_ids`` and ``starts`` say which document and which of its tokens a segment
    begins with. Documents longer than a window are split after each full one and lose nothing.
    Each task packs its own documents in groups, so no row is shuffled, no group exceeds
    memory, and a window is not filled up from other groups. ``docs`` needs ``doc_id`` and
    ``text``; a null text is the end token alone, repeated rows are documents of their own. An empty
    table has no windows.
    """
    if not 0 < window <= 1 << 16:
        raise ValueError("windows have 1 to 65536 tokens")
    path = vocabulary or vocabulary_file()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, number = tokenizer_for(path, MEMO_WORDS), TaskContext.get().partitionId() << 33
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        size = 0
        for batch in batches:
            for part, text in slices(batch, batch.column("text")):
                ids, tokens = with_end(*tokenizer.encode(text), end_id)
                held.append((ids, tokens, part.column("doc_id").to_pylist()))
                size += len(ids)
                if size >= group_tokens:
                    rows = packed_rows(*joined(held), window, pad_id, number)
                    yield rows
                    number, held, size = number + rows.num_rows, [], 0
        if held:
            yield packed_rows(*joined(held), window, pad_id, number)

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), pack, ROWS)


def joined(held: list[tuple[np.ndarray, np.ndarray, list]]) -> tuple[np.ndarray, np.ndarray, list]:
    return (
        np.concatenate([x[0] for x in held]),
        np.concatenate([x[1] for x in held]),
        [d for x in held for d in x[2]],
    )


def write_tokens(docs: DataFrame, path: str, **options) -> None:
    """Write the matrix of all documents as Parquet files, a binary value per row of the matrix."""
    token_matrix(docs, **options).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path)


def segments(matrix: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per segment of a written matrix: its document, where it lies, and its ids cut out again."""
    parts = F.arrays_zip(
        "doc_ids",
        "starts",
        F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("offset"),
        F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("bound"),
    )
    cut = matrix.select("sequence_id", "n_tokens", "ids", "positions", F.explode(parts).alias("s"))
    length = F.col("s.bound") - F.col("s.offset")
    return cut.select(
        F.col("s.doc_ids").alias("doc_id"),
        F.col("s.starts").alias("start"),
        length.cast("long").alias("length"),
        "sequence_id",
        F.col("s.offset").cast("long").alias("offset"),
        F.substring(F.col("ids"), 4 * F.col("s.offset") + 1, 4 * length).alias("ids"),
        F.substring(F.col("positions"), 2 * F.col("s.offset") + 1, 2 * length).alias("positions"),
    )


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents' tokens to the shared folder and read their segments back from the files."""
    spark = docs.sparkSession
    path = work_folder(spark, "tokens")
    write_tokens(docs, path, **options)
    return segments(read_tokens(spark, path), options.get("window", WINDOW))
