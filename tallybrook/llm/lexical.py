"""Ranked lexical search: items against all documents, exact, by ball trees of sparse document vectors."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import LOWER, UPPER, binary_column, slices, spread, stored, words_of

K = 10
# Code points that part terms.
BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
# Bytes of item texts that are searched for in one pass over the documents.
ITEM_BYTES = 4 << 20
# Documents, and (document, term) entries, that one tree is grown of; documents in a leaf.
TREE_DOCS, TREE_ENTRIES, LEAF = 4096, 4 << 20, 32
# Bounds are raised by this share and by one, more than all rounding of doubles can take off.
SAFE = 1e-9

# Each byte as terms need it: A-Z in lower case, other ASCII but digits and letters as a space.
AS_TERMS = np.array(
    [b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256)], np.uint8
)


def terms_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts one after another, and how many each text has; null has none."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    parts = [pa.py_buffer(offsets - offsets[0]), pa.py_buffer(AS_TERMS[raw])]
    return words_of(pa.LargeStringArray.from_buffers(len(text), *parts))


@dataclass
class Items:
    """Items of one pass: their terms as places in ``words``, item by item, and how often each occurs."""

    ids: list[int | None]
    numbers: np.ndarray
    words: pa.Array
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


def item_blocks(items: DataFrame, limit: int) -> Iterator[Items]:
    """The items in blocks of about ``limit`` bytes of text, one item at least; only one block is held at a time."""
    held, size, number = [], 0, 0
    for row in items.toLocalIterator():
        held.append((row.item_id, row.text))
        size += len((row.text or "").encode())
        if size >= limit:
            yield coded_items(held, number)
            held, size, number = [], 0, number + len(held)
    if held:
        yield coded_items(held, number)


def coded_items(held: list[tuple[int | None, str | None]], first: int) -> Items:
    flat, lengths = terms_of(pa.array([text for _, text in held], pa.string()))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    pair, counts = np.unique(np.repeat(np.arange(len(held)), lengths) * size + codes, return_counts=True)
    starts = np.searchsorted(pair // size, np.arange(len(held) + 1))
    return Items([i for i, _ in held], first + np.arange(len(held)), coded.dictionary, starts, pair % size, counts)


def document_terms(docs: DataFrame, words) -> DataFrame:
    """(doc_id, n, terms, tfs): for each document with a term their number, and which of ``words`` occur how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        size = max(1, len(known))
        for batch in batches:
            for part, text in slices(batch, batch.column("text")):
                flat, n = terms_of(text)
                coded = flat.dictionary_encode()
                place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
                term = place.astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
                row = np.repeat(np.arange(len(n)), n)
                pair, tf = np.unique((row * size + term)[term >= 0], return_counts=True)
                held = np.flatnonzero(n)
                ends = np.searchsorted(pair // size, np.arange(len(n) + 1))
                starts, lengths = ends[:-1][held], np.diff(ends)[held]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(held)),
                        pa.array(n[held]),
                        binary_column((pair % size).astype("<i4"), starts, lengths),
                        binary_column(tf.astype("<i4"), starts, lengths),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms binary, tfs binary")


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(joined(batch.column("terms")), minlength=size)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=["term", "df"])

    sums = held.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in sums.collect():
        out[row.term] = row.df
    return out


def joined(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), "<i4").astype(np.int64)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What one unit of a term's weight adds to a document's score, in 64-bit integers."""
    m = 100 - 75 + (75 * n * documents) // max(1, terms)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class BallTree:
    """Documents as sparse vectors of impacts, in halves of halves down to leaves.

    A node knows the centroid of its documents, the radius of the ball around it that holds them, and along
    each of their terms the farthest reach of that ball's content. Both bound the inner product of
    a query with any document below.
    """

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.names, terms = np.unique(terms, return_inverse=True)
        lengths = np.diff(starts)
        order = self._grow(starts[:-1], lengths, terms, values.astype(np.float64))
        at = spread(starts[:-1][order], lengths[order])
        self.ids, self.nulls = ids[order], nulls[order]
        self.terms, self.values = terms[at], values[at]
        self.ends = np.concatenate([[0], np.cumsum(lengths[order])])
        self._sum_up(lengths[order])

    def _grow(self, starts: np.ndarray, lengths: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The documents in the order of the leaves; ``low``, ``high``, ``children`` and ``depth`` of each node."""
        order, axis = np.arange(len(starts)), np.zeros(len(self.names))
        self.low, self.high, self.children, self.depth = [0], [len(order)], [None], [0]
        square = np.bincount(np.repeat(order, lengths), weights=values * values, minlength=len(order))
        at = 0
        while at < len(self.low):
            low, high = self.low[at], self.high[at]
            if high - low > LEAF:
                own = order[low:high]
                place = spread(starts[own], lengths[own])
                row = np.repeat(np.arange(len(own)), lengths[own])
                here, there = terms[place], values[place]

                def along(one: int, here=here, there=there, row=row, size=len(own)) -> np.ndarray:
                    part = slice(starts[one], starts[one] + lengths[one])
                    axis[terms[part]] = values[part]
                    out = np.bincount(row, weights=axis[here] * there, minlength=size)
                    axis[terms[part]] = 0
                    return out

                # Two documents far apart; halves by which of them is nearer.
                first = along(own[0])
                a = own[np.argmax(square[own] - 2 * first)]
                to_a = along(a)
                b = own[np.argmax(square[own] - 2 * to_a)]
                half = (high - low) // 2
                order[low:high] = own[np.argpartition(along(b) - to_a, half)]
                self.children[at] = len(self.low), len(self.low) + 1
                self.low += [low, low + half]
                self.high += [low + half, high]
                self.children += [None, None]
                self.depth += [self.depth[at] + 1] * 2
            at += 1
        return order

    def _sum_up(self, lengths: np.ndarray) -> None:
        """Centroid, radius and reach of each node, kept term by term."""
        size, docs = len(self.names), len(lengths)
        row = np.repeat(np.arange(docs), lengths)
        values = self.values.astype(np.float64)
        square = np.bincount(row, weights=values * values, minlength=docs)
        self.radius = np.zeros(len(self.low))
        found = []
        depth, low, high = (np.array(x) for x in (self.depth, self.low, self.high))
        leaf = np.array([c is None for c in self.children])
        for d in range(int(depth.max()) + 1):
            # Nodes of this depth, and leaves above it, whose documents are summed up once.
            nodes = np.flatnonzero(depth == d)
            of_doc = np.full(docs, -1)
            for node in nodes.tolist():
                of_doc[low[node] : high[node]] = node
            inside = of_doc[row] >= 0
            key, inverse = np.unique(of_doc[row[inside]] * size + self.terms[inside], return_inverse=True)
            node = key // size
            count = (high - low)[node]
            centroid = np.bincount(inverse, weights=values[inside], minlength=len(key)) / count
            reach = np.zeros(len(key))
            np.maximum.at(reach, inverse, values[inside])
            dot = np.bincount(row[inside], weights=values[inside] * centroid[inverse], minlength=docs)
            own = np.bincount(node, weights=centroid * centroid, minlength=len(low))
            here = np.flatnonzero(of_doc >= 0)
            far = np.maximum(square[here] - 2 * dot[here] + own[of_doc[here]], 0)
            # Differences of large squares: what rounding may take off is added before the root.
            far += SAFE * (square[here] + own[of_doc[here]])
            np.maximum.at(self.radius, of_doc[here], np.sqrt(far))
            found.append((key % size, node, centroid, reach))
        self.leaf = leaf
        term, node, centroid, reach = (np.concatenate(x) for x in zip(*found, strict=True))
        by_term = np.argsort(term, kind="stable")
        self.node, self.centroid, self.reach = node[by_term], centroid[by_term], reach[by_term]
        self.of_term = np.searchsorted(term[by_term], np.arange(size + 1))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node a number that no document below scores above, rounded upwards."""
        starts, lengths = self.of_term[terms], self.of_term[terms + 1] - self.of_term[terms]
        at, weight = spread(starts, lengths), np.repeat(weights.astype(np.float64), lengths)
        to_centre = np.bincount(self.node[at], weights=weight * self.centroid[at], minlength=len(self.low))
        to_reach = np.bincount(self.node[at], weights=weight * self.reach[at], minlength=len(self.low))
        ball = to_centre + math.sqrt(float((weights.astype(np.float64) ** 2).sum())) * self.radius
        return np.minimum(ball, to_reach) * (1 + SAFE) + 1

    def search(self, names: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Bring the documents that are among the best of a query into ``best``, subtree by subtree, the most promising first."""
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        known = (self.names[at] == names) & (weights > 0)
        terms, weights = at[known], weights[known]
        if not len(terms):
            return
        bounds = self.bounds(terms, weights).tolist()
        dense = np.zeros(len(self.names), np.int64)
        dense[terms] = weights
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (max(bound, -bounds[child]), child))
                continue
            low, high = self.low[node], self.high[node]
            a, b = self.ends[low], self.ends[high]
            scores = np.add.reduceat(self.values[a:b] * dense[self.terms[a:b]], self.ends[low:high] - a)
            near = np.flatnonzero(scores >= best.least)
            if len(near):
                best.add(scores[near], self.ids[low:high][near], self.nulls[low:high][near])


class Best:
    """The k best documents of a query: higher scores, then smaller ids, null last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def best_documents(held: DataFrame, items: Items, weights: np.ndarray, documents: int, terms: int, k: int) -> DataFrame:
    """(number, item_id, doc_id, score): the k best of each task for each item."""
    sent = held.sparkSession.sparkContext.broadcast((items, weights))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[BallTree]:
        parts: list[tuple] = []
        docs = entries = 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            cuts = np.unique(np.maximum(np.arange(len(lengths)) // TREE_DOCS, np.cumsum(lengths) // TREE_ENTRIES), return_index=True)[1]
            for a, b in zip(cuts, [*cuts[1:], len(lengths)], strict=True):
                part = batch.slice(a, b - a).filter(pa.array(lengths[a:b] > 0))
                if not part.num_rows:
                    continue
                own = lengths[a:b][lengths[a:b] > 0]
                n = part.column("n").to_numpy(zero_copy_only=False)
                tf = joined(part.column("tfs"))
                ids = part.column("doc_id")
                parts.append(
                    (
                        pc.fill_null(ids, 0).to_numpy(zero_copy_only=False),
                        pc.is_null(ids).to_numpy(zero_copy_only=False),
                        own,
                        joined(part.column("terms")),
                        impacts(tf, np.repeat(n, own), documents, terms),
                    )
                )
                docs, entries = docs + len(own), entries + len(tf)
                if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                    yield tree(parts)
                    parts, docs, entries = [], 0, 0
        if parts:
            yield tree(parts)

    def tree(parts: list[tuple]) -> BallTree:
        ids, nulls, lengths, own, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        return BallTree(ids, nulls, np.concatenate([[0], np.cumsum(lengths)]), own, values)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        best = [Best(k) for _ in items.ids]
        for grown in trees(batches):
            for q, own in enumerate(best):
                part = slice(items.starts[q], items.starts[q + 1])
                grown.search(items.terms[part], items.counts[part] * weights[items.terms[part]], own)
        of = np.repeat(np.arange(len(best)), [len(x.ids) for x in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(items.numbers[of]),
                pa.array(items.ids, pa.int64()).take(pa.array(of)),
                pa.array(np.concatenate([x.ids for x in best]), mask=np.concatenate([x.nulls for x in best])),
                pa.array(np.concatenate([x.scores for x in best])),
            ],
            names=["number", "item_id", "doc_id", "score"],
        )

    return held.mapInArrow(search, "number long, item_id long, doc_id long, score long")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents that score highest, all if fewer score above 0.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns are left out. A
    null or empty text has no terms: such a document counts nowhere, such an item has no result. Items
    alike in id and text are one; those of one id with other texts, or without an id, are searched for each by
    itself. Repeated documents are ranked each for themselves; equal scores go to the smaller id, null last.

    Items are searched for in blocks of ``item_bytes``, which every task holds; each block is one pass over the texts
    of all documents, in which only its terms are kept. Tasks hand on k documents per item. Scores are exact
    below 2^63.
    """
    spark = docs.sparkSession
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    hits = None
    for block in item_blocks(stored(own.distinct(), "items"), item_bytes):
        held = stored(document_terms(docs, spark.sparkContext.broadcast(block.words)), "doc-terms")
        sums = held.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = document_counts(held, len(block.words))
        weights = np.array([term_weight(sums.documents, n) for n in df.tolist()], np.int64)
        found = stored(best_documents(held, block, weights, sums.documents, sums.terms, k), "hits")
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


_TERMS_SQL = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{BETWEEN}]+')"
RANKED_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS number, doc_id, {_TERMS_SQL} AS terms FROM documents WHERE text IS NOT NULL),
totals AS (SELECT CAST(COUNT(*) AS BIGINT) AS all_docs, CAST(SUM(len(terms)) AS BIGINT) AS all_terms FROM texts WHERE len(terms) > 0),
counts AS (
  SELECT number, doc_id, CAST(n AS BIGINT) AS n, term, CAST(COUNT(*) AS BIGINT) AS tf
  FROM (SELECT number, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts) GROUP BY number, doc_id, n, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, all_docs),
asked AS (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark),
scored AS (
  SELECT item_id, number, doc_id,
         CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term), totals GROUP BY item_id, number, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {K}
"""
