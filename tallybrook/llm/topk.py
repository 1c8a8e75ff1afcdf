"""Exact top-k search by inner product: MaxScore over blocks of postings, merged over all blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import map_batches, stored

SCALE = 1024
K = 10
# Vectors of a block of postings, queries of a block, and bytes of queries that every task holds in one pass over the vectors.
BLOCK, QUERY_BLOCK, QUERY_BYTES = 4096, 256, 64 << 20
# Non-essential terms probed before candidates are dropped again.
STEP = 8

PACKED = "numbers binary, ids binary, weights binary, terms int"


def packed_vectors(vectors: DataFrame, block: int, scale: int = SCALE) -> DataFrame:
    """Blocks of vectors as postings: a row of weights per term, for all vectors of the block.

    A component x becomes floor(scale * x) in 64-bit integers. Vectors that are null, empty, or
    hold a null or a component that is not finite are left out, and so are such without an id, and those with
    a component that 64 bits do not hold. Vectors of different lengths may meet: a missing component weighs nothing.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                lists = part.column("vector")
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                if not len(lengths):
                    continue
                terms = int(lengths.max())
                values = np.zeros((len(lengths), terms))
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                row = np.repeat(np.arange(len(lengths)), lengths)
                values[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
                weights = np.floor(scale * values).astype("<i8").T
                names = [part.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("number", "id")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([x.tobytes()], pa.binary()) for x in names),
                        pa.array([np.ascontiguousarray(weights).tobytes()], pa.binary()),
                        pa.array([terms], pa.int32()),
                    ],
                    names=["numbers", "ids", "weights", "terms"],
                )

    # Also false for what is not finite.
    fits = F.forall("vector", lambda x: F.coalesce(F.abs(x) * scale < 2.0**63, F.lit(False)))
    whole = vectors.where("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0").where(fits)
    return map_batches(whole, pack, PACKED)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    weights = np.frombuffer(row["weights"], "<i8").reshape(row["terms"], -1)
    return np.frombuffer(row["numbers"], "<i8"), np.frombuffer(row["ids"], "<i8"), weights


def size_of_sums(left: np.ndarray, right: np.ndarray) -> float:
    """What no inner product of rows of one and columns of the other exceeds, signs aside."""
    return float(np.abs(left.astype(float)).max(initial=0)) * float(np.abs(right.astype(float)).max(initial=0)) * max(1, left.shape[-1])


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An exact integer product; by floating point where all sums stay below 2 to the 53.

    Sums that 64 bits do not hold become the nearest number that they do.
    """
    most = size_of_sums(left, right)
    if most < 2.0**53:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    if most < 2.0**63:
        return left @ right
    exact = left.astype(object) @ right.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Best:
    """The k best (score, id) of each query of a block: higher scores first, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries

    def least(self, q: int) -> int | None:
        """A score that no later candidate may fall below; none as long as there are fewer than k."""
        return int(self.scores[q][-1]) if len(self.scores[q]) == self.k else None

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        if len(scores) > 4 * self.k:
            floor = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= floor
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]


def max_score(queries: np.ndarray, query_numbers: np.ndarray, block: np.ndarray, numbers: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Add a block of postings to the best of each query, but not the query's own row.

    ``block`` has a row of postings per term. A term can add its largest product with the block's
    weights at most. Terms are taken by how far their products spread; those at the end whose
    bounds together cannot lift the lowest possible score to the k-th best are non-essential.
    The postings of the essential terms are traversed for all vectors; the others are probed
    in steps, for vectors whose score with all that is left may still reach the k-th best.
    """
    terms = min(queries.shape[1], block.shape[0])
    queries, block = queries[:, :terms], block[:terms]
    high, low = block.max(1), block.min(1)
    # Where sums may leave 64 bits no bound holds; such vectors are scored in full.
    bounded = size_of_sums(queries, block) < 2.0**62
    for q in range(len(queries)):
        weights, own = queries[q], query_numbers[q]
        if best.least(q) is None or not bounded:
            first = slice(0, 8 * best.k if bounded else len(ids))
            other = numbers[first] != own
            best.add(q, product(weights[None], block[:, first])[0][other], ids[first][other])
            rest = np.arange(len(ids))[first.stop :]
        else:
            rest = np.arange(len(ids))
        rest = rest[numbers[rest] != own]
        if not len(rest):
            continue
        least = best.least(q)
        if least is None:
            best.add(q, product(weights[None], block[:, rest])[0], ids[rest])
            continue
        most, fewest = np.maximum(weights * high, weights * low), np.minimum(weights * high, weights * low)
        order = np.argsort(fewest - most, kind="stable")
        weights, most, fewest = weights[order], most[order], fewest[order]
        left = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
        spread = np.concatenate([np.cumsum((most - fewest)[::-1])[::-1], [0]])
        essential = max(1, int(np.flatnonzero(fewest.sum() + spread < least).min(initial=terms)))
        scores = product(weights[None, :essential], block[order[:essential]])[0][rest]
        at = essential
        while len(rest):
            may = scores + left[at] >= least
            rest, scores = rest[may], scores[may]
            if at == terms or not len(rest):
                break
            some = slice(at, min(at + STEP, terms))
            scores = scores + product(weights[None, some], block[np.ix_(order[some], rest)])[0]
            at = some.stop
        if len(rest):
            best.add(q, scores, ids[rest])


def query_blocks(queries: DataFrame, limit: int) -> Iterator[list[dict]]:
    """Blocks of packed queries, about ``limit`` bytes at a time and one block at least; the driver holds no more."""
    held, size = [], 0
    for row in queries.toLocalIterator():
        held.append(row.asDict())
        size += len(row.weights)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def best_vectors(candidates: DataFrame, asked: list[dict], k: int) -> DataFrame:
    """(number, query_id, vec_id, score): the k best vectors of each task for each of the queries that it holds."""
    sent = candidates.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [unpacked(row) for row in sent.value]
        best = [Best(len(ids), k) for _, ids, _ in blocks]
        for batch in batches:
            for row in batch.to_pylist():
                numbers, ids, postings = unpacked(row)
                for (query_numbers, _, weights), own in zip(blocks, best, strict=True):
                    max_score(weights.T, query_numbers, postings, numbers, ids, own)
        for (query_numbers, query_ids, _), own in zip(blocks, best, strict=True):
            lengths = [len(x) for x in own.ids]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_numbers, lengths)),
                    pa.array(np.repeat(query_ids, lengths)),
                    pa.array(np.concatenate(own.ids)),
                    pa.array(np.concatenate(own.scores)),
                ],
                names=["number", "query_id", "vec_id", "score"],
            )

    return map_batches(candidates, search, "number long, query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    is_query: Column | None,
    k: int = K,
    scale: int = SCALE,
    block: int = BLOCK,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the highest inner product, for each query.

    ``vectors`` needs ``id`` and ``vector``; ``is_query`` marks the queries, which meet all vectors but their own
    row. Rows are told apart by a number that is stored with them: of rows with one id each is a vector and, if
    marked, a query of its own, with ranks of its own, and may find the others. Ties go to the smaller id. A score
    beyond 64 bits is given as the nearest number of 64 bits. Without queries or other vectors there are no rows.

    Every task holds the queries of a pass, ``query_bytes`` of them, and k candidates for each, while the blocks of
    vectors go by; what it has found is merged over all tasks.
    """
    whole = vectors.withColumn("_asked", F.expr("true") if is_query is None else F.coalesce(is_query, F.lit(False)))
    own = whole.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), "_asked")
    own = stored(own.withColumn("number", F.monotonically_increasing_id()), "vectors")
    queries = stored(packed_vectors(own.where("_asked"), QUERY_BLOCK, scale), "query-blocks")
    candidates = stored(packed_vectors(own, block, scale), "postings")
    hits = None
    for asked in query_blocks(queries, query_bytes):
        found = stored(best_vectors(candidates, asked, k), "hits")
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 10
"""
