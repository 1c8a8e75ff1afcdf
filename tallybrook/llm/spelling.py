"""Spelling variants: words one edit apart, found by Gram matrices of letter counts, and the form each leads to."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import slices, stored, words_of

LEAST_LENGTH, LEAST_COUNT = 5, 3
# Of the runs whose hash this number divides, one letter is deleted.
DAMAGED = 97
# A word's form occurs so many times as often at least.
TIMES = 2

# Letters in a fixed order, dealt to groups in turn; blocks hold words with as many letters of each group.
LETTERS = "etaoinshrdlucmfwypvbgkjqxz" + "".join(map(chr, range(0xC0, 0x100)))
GROUPS = 5
# Words and bytes of a block at most, on average; letters compared at once.
BLOCK, BLOCK_BYTES, COMPARED = 1024, 1 << 20, 4 << 20
# Distinct words that a task sums up before it hands them on.
GATHERED = 500_000

PLACE = np.zeros(256, np.int64)
PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))

# A to Z in lower case, a to z and the first byte of U+00C0 to U+00FF as they are, other bytes as a space.
RUN_BYTES = np.full(256, 32, np.uint8)
RUN_BYTES[97:123] = RUN_BYTES[65:91] = np.arange(97, 123)
LEAD = 0xC3
RUN_BYTES[LEAD] = LEAD


def runs_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of letters of all texts one after another, A-Z lower-cased, and how many each text has."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    out = RUN_BYTES[raw]
    second = np.flatnonzero(raw[:-1] == LEAD) + 1
    out[second] = raw[second]
    parts = [pa.py_buffer(offsets - offsets[0]), pa.py_buffer(out)]
    return words_of(pa.LargeStringArray.from_buffers(len(text), *parts))


def without(word: bytes, at: int) -> str:
    text = word.decode()
    return text[: at % len(text)] + text[at % len(text) + 1 :]


def counted_words(text: pa.Array, ids: list) -> pa.Table:
    """(word, n) of some texts: runs as they are, and with a letter less where their hash says so."""
    flat, counts = runs_of(text)
    coded = flat.dictionary_encode()
    size = max(1, len(coded.dictionary))
    row = np.repeat(np.arange(len(counts)), counts)
    pair, times = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    row, code = pair // size, pair % size
    runs = np.array(coded.dictionary.cast(pa.large_binary()).to_pylist(), object)
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], object)
    hashes = np.fromiter(map(zlib.crc32, runs[code].tolist(), before[row].tolist()), np.int64, len(pair))
    hit = hashes % DAMAGED == 0
    sums = np.bincount(code[~hit], weights=times[~hit], minlength=size)[: len(coded.dictionary)].astype(np.int64)
    cut = [without(w, h) for w, h in zip(runs[code[hit]].tolist(), hashes[hit].tolist(), strict=True)]
    words = pa.concat_arrays([coded.dictionary, pa.array(cut, pa.large_string())])
    found = pa.table({"word": words, "n": np.concatenate([sums, times[hit]])})
    long = pc.and_(pc.greater_equal(pc.utf8_length(words), LEAST_LENGTH), pc.greater(found["n"], 0))
    return found.filter(long)


def word_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of ``LEAST_LENGTH`` letters and ``least`` occurrences over all texts. Tasks sum up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part, text in slices(batch, batch.column("text")):
                held.append(counted_words(text, part.column("doc_id").to_pylist()))
                size += held[-1].num_rows
                if size > GATHERED:
                    held = [summed(held)]
                    size = held[0].num_rows
                    if 2 * size > GATHERED:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    def summed(tables: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": sums["word"].cast(pa.string()), "n": sums["n_sum"].cast(pa.int64())})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_groups(groups: int = GROUPS) -> list[str]:
    return [LETTERS[k::groups] for k in range(groups)]


def steps(groups: int = GROUPS) -> list[tuple[int, ...]]:
    """How the letter counts by group may differ between words one edit apart, each pair of words seen from one side.

    A replaced letter keeps them, or takes one from a group and adds one to a later; an inserted one adds one.
    """
    unit = np.eye(groups, dtype=int)
    replaced = [tuple((unit[j] - unit[i]).tolist()) for i in range(groups) for j in range(i + 1, groups)]
    return [(0,) * groups, *replaced, *(tuple(u.tolist()) for u in unit)]


def block_pairs(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(left, right, same): blocks of words that may be one edit apart, each pair of blocks once.

    A block's words have as many letters of each group, and so one length; only blocks of the same or the
    next length whose counts are a step apart meet. Blocks are bounded, and each pair is a row that is
    dealt by both its blocks, so no group of words is the work of one task.
    """
    kinds = F.array(*[F.regexp_count("word", F.lit(f"[{letters}]")) for letters in letter_groups(groups)])
    kept = stored(words.withColumn("kind", kinds), "spelled")
    volume = F.sum(F.octet_length("word"))
    sizes = kept.groupBy("kind").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(volume / BLOCK_BYTES)).alias("blocks"))
    sizes = stored(sizes, "spelled-kinds")
    numbered = kept.join(sizes, "kind").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")))
    blocks = numbered.groupBy("kind", "block").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("of"))
    blocks = stored(blocks, "spelled-blocks")
    step = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in steps(groups)]))
    near = blocks.select("kind", "block", step.alias("step"))
    near = near.withColumn("r_kind", F.zip_with("kind", "step", lambda a, b: a + b)).where(~F.exists("r_kind", lambda x: x < 0))
    named = sizes.select(F.col("kind").alias("r_kind"), F.col("blocks").alias("r_blocks"))
    near = near.join(named, "r_kind").withColumn("r_block", F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)))
    near = near.where("kind != r_kind OR r_block >= block").select("kind", "block", "r_kind", "r_block")
    left = blocks.select("kind", "block", F.col("of").alias("left"))
    right = blocks.select(F.col("kind").alias("r_kind"), F.col("block").alias("r_block"), F.col("of").alias("right"))
    met = near.join(left.hint("merge"), ["kind", "block"]).join(right.hint("merge"), ["r_kind", "r_block"])
    return met.select("left", "right", F.expr("kind = r_kind AND block = r_block").alias("same"))


def letters(words: list[str]) -> np.ndarray:
    """A row of letters, a byte each, for each of some words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row; in floats whose products are exact."""
    n, length = rows.shape
    at = np.repeat(np.arange(n) * len(LETTERS), length) + PLACE[rows.ravel()]
    kind = np.float32 if length < 4096 else np.float64
    return np.bincount(at, minlength=n * len(LETTERS)).reshape(n, -1).astype(kind)


def close_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose letter counts have a squared distance of two at most, from the product of both blocks' counts."""
    a, b = letter_counts(left), letter_counts(right)
    distance = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(distance <= 2)
    return (i[i < j], j[i < j]) if same else (i, j)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become those of ``b`` by replacing one letter, or inserting one where these are longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    before = np.ones((len(a), a.shape[1] + 1), bool)
    after = before.copy()
    before[:, 1:] = np.logical_and.accumulate(a == b[:, :-1], axis=1)
    after[:, :-1] = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return (before & after).any(1)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the one that occurs most, as ``-n`` and ``word``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in range(batch.num_rows):
                sides = [batch.column(c)[r].values for c in ("left", "right")]
                names = [side.field("word").to_pylist() for side in sides]
                counts = [side.field("n").to_numpy(zero_copy_only=False) for side in sides]
                a, b = map(letters, names)
                i, j = close_pairs(a, b, batch.column("same")[r].as_py())
                step = max(1, COMPARED // max(1, b.shape[1]))
                near = [one_edit(a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)]
                near = np.concatenate([*near, np.zeros(0, bool)])
                i, j = i[near], j[near]
                out += best_of(i, j, names[0], names[1], counts[1])
                out += best_of(j, i, names[1], names[0], counts[0])
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "k", "less", "near"]
            )

    found = block_pairs(words).mapInArrow(compare, "word string, k long, less long, near string")
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))


def best_of(own: np.ndarray, other: np.ndarray, names: list[str], others: list[str], n: np.ndarray) -> list[tuple]:
    """Of each word in some pairs: itself, its number of pairs, and the most frequent other one, which are in order."""
    order = np.lexsort((other, -n[other], own))
    found, first, times = np.unique(own[order], return_index=True, return_counts=True)
    top = other[order][first]
    return [
        (names[w], k, -less, others[t])
        for w, k, less, t in zip(found.tolist(), times.tolist(), n[top].tolist(), top.tolist(), strict=True)
    ]


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where (word, form) leads in the end.

    Each round doubles the length of the steps. A form occurs twice as often as its word, so
    chains are no longer than the logarithm of the highest count, and a form has no more words than
    edits of it, so no join is uneven.
    """
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(onward.hint("merge"), "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        links = stored(moved, "roots")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs ``least`` times.

    Words are runs of the letters a-z and U+00C0 to U+00FF, A-Z lower-cased, of five letters at least;
    in one of 97 cases, by a hash of ``doc_id`` and run, the run without one letter. Near words are one
    edit apart; a word's form is the near word that occurs most, the first in code-point order of several, if it
    occurs ``times`` times as often as the word; the root is where forms lead. ``docs`` needs ``doc_id`` and
    ``text``; other columns are left out. A null text has no words, a null id is hashed as an empty one,
    repeated rows count each. Without words there are no rows.
    """
    words = stored(word_counts(docs, least), "words")
    near = stored(near_words(words), "near-words")
    joined = words.join(near.hint("merge"), "word", "left")
    known = -F.col("best.less") >= times * F.col("n")
    formed = joined.select(
        "word",
        F.when(known, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(known, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    rooted = roots(formed.where("form IS NOT NULL"))
    return formed.join(rooted.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
