"""Near-duplicates by SetSketch: banded registers propose, their likelihood selects, full sets confirm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import SPACES, coded_words, lower_ascii, map_batches, rows_held, slices, stored

SHINGLE = 5
SIMILARITY = 80
# Registers of a sketch are cut into bands; documents that agree in one band are compared.
BANDS, ROWS = 40, 5
# Base and rate of the registers' exponential scale, and their largest value, which one byte holds.
BASE, RATE, LARGEST = 1.1, 8.0, 255
# A pair is dropped only where its registers are exp(-this) times less likely at the threshold than at best.
DOUBT = 12.5
# Members of a hub, and bytes of their texts, that one row compares with as many others.
BLOCK, BLOCK_BYTES = 256, 1 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as 64-bit hashes, text by text in ascending order, and their number.

    A-Z are lower-cased. A text with fewer words than ``size`` has one shingle, the whole; a text
    without words, or null, has none.
    """
    distinct, codes, counts = coded_words(pc.ascii_lower(text))
    words = pd.util.hash_array(distinct.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)[codes]
    n, ends = len(text), np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    row = np.repeat(np.arange(n), counts)
    found, of = [], []
    if len(words) >= size:
        whole = np.flatnonzero(row[: len(row) - size + 1] == row[size - 1 :])
        value = np.zeros(len(whole), np.uint64)
        for k in range(size):
            value = value * MIX + words[whole + k]
        found.append(mixed(value))
        of.append(row[whole])
    for i in short.tolist():
        value = np.zeros(1, np.uint64)
        for w in words[ends[i] - counts[i] : ends[i]]:
            value = value * MIX + w
        found.append(mixed(value ^ counts[i].astype(np.uint64)))
        of.append(np.array([i]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    value, row = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[first], np.bincount(row[first], minlength=n).astype(np.int64)


def multipliers(registers: int) -> np.ndarray:
    """One odd multiplier per register, from a fixed seed."""
    return mixed(np.arange(1, registers + 1, dtype=np.uint64) * MIX) | np.uint64(1)


def set_sketches(hashes: np.ndarray, counts: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """A row of registers for each set; rows of empty sets are 0.

    Each register draws an exponential of rate ``RATE`` per element from a hash of its own and
    keeps floor(1 - log of the least, to the base ``BASE``), cut off at 0 and ``LARGEST``.
    Registers of a union are the larger ones of both sides, so sketches can be merged. The
    least exponential belongs to the least hash, so the logarithm is taken once per register.
    """
    out = np.zeros((len(counts), registers), np.uint8)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    starts = (np.cumsum(counts) - counts)[full]
    for k, factor in enumerate(multipliers(registers)):
        least = np.minimum.reduceat(hashes * factor, starts).astype(np.float64) + 0.5
        exponential = -np.log1p(-np.minimum(least / 2.0**64, 1 - 2.0**-53)) / RATE
        out[full, k] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST)
    return out


def likely_similar(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int = SIMILARITY
) -> np.ndarray:
    """Which pairs may reach the similarity, by the joint likelihood of their registers.

    For sets of known sizes the numbers of registers that are larger on the left, on the right,
    and equal follow a law with the Jaccard similarity as its only unknown. A pair passes if the
    likeliest similarity reaches the threshold, or the threshold is not ``DOUBT`` less likely
    in logarithms. Sizes too different to reach it never pass.
    """
    n_left, n_right = n_left.astype(float), n_right.astype(float)
    most = np.minimum(n_left, n_right) / np.maximum(n_left, n_right)
    possible = 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    more, fewer = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - fewer
    u, v = n_left / (n_left + n_right), n_right / (n_left + n_right)

    def law(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        larger, smaller = np.maximum(law(u - v * j), 1e-12), np.maximum(law(v - u * j), 1e-12)
        return more * np.log(larger) + fewer * np.log(smaller) + same * np.log(np.maximum(1 - larger - smaller, 1e-12))

    at = likelihood(np.minimum(percent / 100, most))
    best = np.max([likelihood(np.minimum(j, most)) for j in np.linspace(0, percent / 100, 33)], axis=0)
    return possible & (best - at <= DOUBT)


def same_words(text: Column, seed: int = 0) -> Column:
    """A 64-bit hash of the lower-cased words in order: equal for texts that differ only in white space and case."""
    words = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), f"[{SPACES}]+", " "))
    return F.xxhash64(F.lit(seed), words)


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, node, n, registers): ``node`` is the hash of the words, ``n`` the number of distinct shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in slices(batch, batch.column("text")):
                hashes, counts = shingle_hashes(text, size)
                registers = set_sketches(hashes, counts)
                width = registers.shape[1]
                raw = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(width), len(registers), [None, pa.py_buffer(np.ascontiguousarray(registers))]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("node"), pa.array(counts), raw.cast(pa.binary())],
                    names=["doc_id", "node", "n", "registers"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long"), same_words(F.col("text")).alias("node"), F.col("text").cast("string")
    )
    return map_batches(rows, sketch, "doc_id long, node long, n long, registers binary")


def shuffled(df: DataFrame) -> DataFrame:
    """Joined by shuffling at every size: what grows with the documents is never broadcast."""
    return df.hint("merge")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of (x, y) those whose registers allow the similarity."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("x_n", "y_n")]
                own = [matrix(batch.column(c), BANDS * ROWS) for c in ("x_registers", "y_registers")]
                yield batch.select(["x", "y"]).filter(pa.array(likely_similar(*own, *n, percent)))

    x, y = (
        classes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("registers").alias(f"{c}_registers"))
        for c in "xy"
    )
    met = pairs.join(shuffled(x), "x").join(shuffled(y), "y")
    return map_batches(met.select("x", "y", "x_n", "y_n", "x_registers", "y_registers"), select, "x long, y long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of (x, y) those whose full shingle sets are similar: 100 * intersection >= percent * union."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x_text in slices(batch, batch.column("x_text")):
                (a, a_n), (b, b_n) = shingle_hashes(x_text, size), shingle_hashes(part.column("y_text"), size)
                pair = np.concatenate([np.repeat(np.arange(len(n)), n) for n in (a_n, b_n)])
                both = np.concatenate([a, b])
                order = np.lexsort((both, pair))
                both, pair = both[order], pair[order]
                twice = (both[1:] == both[:-1]) & (pair[1:] == pair[:-1])
                common = np.bincount(pair[1:][twice], minlength=part.num_rows)
                yield part.select(["x", "y"]).filter(pa.array(enough(common, a_n, b_n, percent)))

    met = pairs.join(shuffled(texts.select(F.col("node").alias("x"), F.col("text").alias("x_text"))), "x")
    met = met.join(shuffled(texts.select(F.col("node").alias("y"), F.col("text").alias("y_text"))), "y")
    return map_batches(met.select("x", "y", "x_text", "y_text"), confirm, "x long, y long")


def enough(common: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    return (100 * common >= percent * (left + right - common)) & (common > 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of (x, y): the smallest node that each can reach, itself included.

    Large stars and small stars in turn: every node hands its larger neighbours, then its smaller
    ones, to the smallest, until all edges lead to the roots. Rounds grow with the logarithm
    of the longest chain; each one is written, and only a checksum comes to the driver.
    """
    links = stored(edges.where("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x != y").distinct()
        small = large.groupBy("x").agg(F.min("y").alias("m"))
        moved = large.join(small, "x").where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        links = stored(moved.union(small.select("x", F.col("m").alias("y"))).distinct(), "links")
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("y").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("x").alias("node"), F.col("y").alias("root")).union(roots)


MEMBER = "node long, root long, n long, registers binary, text string"


def block_pairs(members: DataFrame) -> DataFrame:
    """(hub, left, right, same): blocks of each hub's members, those of the rest with all others.

    ``members`` has a hub's neighbours and itself, marked as in its component or in the ``rest``; those
    in its component need not be compared with each other. Blocks are dealt by hash and bounded
    in members and text. The pairs of blocks are written out from the hub's number of blocks, and each finds
    its blocks by hub and number, so a hub of any size is spread over as many tasks as it has blocks.
    """
    volume = F.sum(F.octet_length("text"))
    sizes = members.groupBy("hub", "rest").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(volume / BLOCK_BYTES), F.lit(1)).alias("blocks")
    )
    sizes = stored(sizes, "hub-sizes")
    numbered = members.join(sizes, ["hub", "rest"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    fields = [x.split()[0] for x in MEMBER.split(", ")]
    blocks = numbered.groupBy("hub", "rest", "block").agg(F.collect_list(F.struct(*fields)).alias("of"))
    blocks = stored(blocks, "blocks")
    counts = sizes.groupBy("hub").agg(
        F.max(F.when(F.col("rest"), F.col("blocks"))).alias("open"),
        F.coalesce(F.max(F.when(~F.col("rest"), F.col("blocks"))), F.lit(0)).alias("core"),
    )
    pairs = counts.where("open IS NOT NULL").withColumn("block", F.expr("explode(sequence(0L, open - 1))"))
    others = F.expr(
        "concat(transform(sequence(block, open - 1), j -> named_struct('r_rest', true, 'r_block', j)),"
        " if(core > 0, transform(sequence(0L, core - 1), j -> named_struct('r_rest', false, 'r_block', j)), array()))"
    )
    pairs = pairs.select("hub", "block", F.inline(others))
    # Of two open blocks either may be the right one; by turns, each is so for about half of the others.
    turned = F.expr("r_rest AND (block + r_block) % 2 = 1")
    pairs = pairs.select(
        "hub",
        "r_rest",
        F.when(turned, F.col("r_block")).otherwise(F.col("block")).alias("block"),
        F.when(turned, F.col("block")).otherwise(F.col("r_block")).alias("r_block"),
    )
    left = blocks.where("rest").select("hub", "block", F.col("of").alias("left"))
    right = blocks.select("hub", F.col("rest").alias("r_rest"), F.col("block").alias("r_block"), F.col("of").alias("right"))
    met = pairs.join(shuffled(left), ["hub", "block"]).join(shuffled(right), ["hub", "r_rest", "r_block"])
    return met.select("hub", "left", "right", F.expr("r_rest AND r_block = block").alias("same"))


def likely_cross(left: pa.Scalar, right: pa.Scalar, same: bool, percent: int) -> tuple:
    """Both blocks' columns, and the places of the pairs in different components that may be similar."""
    sides = [
        {c: x.values.field(c) for c in ("node", "root", "n", "registers", "text")} for x in (left, right)
    ]
    for side in sides:
        for c in ("node", "root", "n"):
            side[c] = side[c].to_numpy(zero_copy_only=False)
        side["registers"] = matrix(side["registers"], BANDS * ROWS)
    one, other = sides
    i, j = np.nonzero(one["root"][:, None] != other["root"][None, :])
    if same:
        i, j = i[i < j], j[i < j]
    kept = []
    for at in range(0, len(i), 1 << 14):
        p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        ok = likely_similar(one["registers"][p], other["registers"][q], one["n"][p], other["n"][q], percent)
        kept.append(np.stack([p[ok], q[ok]]))
    found = np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)
    return one, other, found[0], found[1]


def undecided(members: DataFrame, percent: int) -> DataFrame:
    """(hub, node) of the members that may be similar to one in another component."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs, nodes = [], []
            for r in range(batch.num_rows):
                hub, left, right, same = (batch.column(c)[r] for c in ("hub", "left", "right", "same"))
                one, other, i, j = likely_cross(left, right, same.as_py(), percent)
                found = np.unique(np.concatenate([one["node"][i], other["node"][j]]))
                nodes.append(found)
                hubs.append(np.full(len(found), hub.as_py()))
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hubs, nodes)], names=["hub", "node"])

    without = members.withColumn("text", F.lit(None).cast("string"))
    return map_batches(block_pairs(without), mark, "hub long, node long").distinct()


def links_across(members: DataFrame, size: int, percent: int) -> DataFrame:
    """(x, y): similar members of different components, as many as it takes to join all that are linked.

    Full sets are compared inside the task that holds both blocks; pairs that others have joined
    already are left out, and pairs that are not similar are never written.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                left, right, same = (batch.column(c)[r] for c in ("left", "right", "same"))
                one, other, i, j = likely_cross(left, right, same.as_py(), percent)
                if not len(i):
                    continue
                joined: dict[int, int] = {}

                def root(x: int) -> int:
                    while x in joined:
                        x = joined[x]
                    return x

                sets = [sets_of(x["text"], size) for x in (one, other)]
                xs, ys = [], []
                for p, q in zip(i.tolist(), j.tolist(), strict=True):
                    a, b = root(int(one["root"][p])), root(int(other["root"][q]))
                    if a != b:
                        s, t = sets[0][p], sets[1][q]
                        common = len(np.intersect1d(s, t, assume_unique=True))
                        if enough(np.int64(common), len(s), len(t), percent):
                            joined[max(a, b)] = min(a, b)
                            xs.append(int(one["node"][p]))
                            ys.append(int(other["node"][q]))
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    return map_batches(block_pairs(members), link, "x long, y long")


def sets_of(text: pa.Array, size: int) -> list[np.ndarray]:
    hashes, counts = shingle_hashes(text, size)
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(counts) else []


def second_links(tried: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between documents that met at one hub but are in different components so far.

    Whoever met in a bucket met at the same hub. Hubs whose members are all in one component are
    done, and so are those with one member, which has been compared with the hub. Members that
    no register allows to be similar to another component are set aside before any text moves.
    """
    met = tried.select(F.col("y").alias("hub"), F.col("x").alias("node"))
    met = met.union(met.select("hub", F.col("hub").alias("node")).distinct())
    named = met.join(labels, "node", "left").select("hub", "node", F.coalesce("root", "node").alias("root"))
    hubs = labels.select(F.col("node").alias("hub"), F.col("root").alias("core"))
    named = named.join(hubs, "hub", "left").withColumn("rest", F.col("root") != F.coalesce("core", "hub"))
    named = stored(named.select("hub", "node", "root", "rest"), "met")
    open_ = named.groupBy("hub").agg(F.count("*").alias("all"), F.count_if("rest").alias("others"))
    named = named.join(open_.where("others > 0 AND all > 2").select("hub"), "hub", "left_semi")
    members = stored(named.join(shuffled(classes), "node"), "members")
    marked = undecided(members, percent)
    return links_across(stored(members.join(shuffled(marked), ["hub", "node"]).join(shuffled(texts), "node"), "undecided"), size, percent)


def class_texts(docs: DataFrame, rows: DataFrame, tried: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``tried``, from one document of each.

    Documents are found by node and id together, so thousands of copies of a text do not meet
    in one task.
    """
    nodes = tried.select(F.col("x").alias("node")).union(tried.select("y")).distinct()
    ones = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("one")).join(nodes, "node", "left_semi")
    ones = ones.withColumnRenamed("node", "of")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").select(
        "id", same_words(F.col("text")).alias("node"), F.col("text").cast("string").alias("text")
    )
    found = texts.join(shuffled(ones), (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("one")))
    return found.groupBy("node").agg(F.min("text").alias("text"))


def near_duplicate_classes(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) of all documents, and (node, root) of all nodes that are similar to others.

    Texts with the same words in order are one node, sketched once per document and compared
    once. Per band, nodes with equal registers meet at the smallest of them, the hub, so a
    bucket of any size gives a pair per member; those that met at a hub and remain in different
    components are compared afterwards, so no link found by a band is lost. All tables in
    between are written to the shared folder.
    """
    rows = stored(sketches(docs, size), "sketches")
    classes = rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("registers").alias("registers"))
    classes = stored(classes, "classes")
    cut = [F.xxhash64(F.lit(k), F.substring("registers", k * ROWS + 1, ROWS)) for k in range(BANDS)]
    bands = classes.select("node", F.explode(F.array(*cut)).alias("key"))
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub != last")
    met = bands.join(shuffled(hubs.select("key", "hub")), "key").where("node != hub")
    tried = stored(met.select(F.col("node").alias("x"), F.col("hub").alias("y")).distinct(), "tried")
    texts = stored(class_texts(docs, rows, tried), "dup-texts")
    likely = stored(likely_pairs(tried, classes, percent), "likely")
    first = stored(confirmed(likely, texts, size, percent), "links")
    labels = stored(components(first), "labels")
    second = stored(second_links(tried, labels, classes, texts, size, percent), "links")
    if not second.isEmpty():
        labels = stored(components(first.union(second)), "labels")
    return rows.select("doc_id", "node", "n"), labels


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Documents are linked where 100 * intersection >= percent * union of their sets of distinct
    ``size``-word shingles; a text with fewer words is one shingle; a text without words is
    linked with nothing. ``component_id`` is the smallest ``doc_id`` that links lead to, and a
    document is kept if it is its own. ``docs`` needs ``doc_id`` and ``text``; other columns are
    left out. A null id is the component's only where no member has one. No rows, no result.
    """
    rows, labels = near_duplicate_classes(docs, size, percent)
    names = stored(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")), "least")
    rooted = names.join(labels, "node").select("node", "root", "least")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = rooted.join(groups, "root").select("node", "component_id")
    of_node = names.join(of_node, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    with_words = rows.where("n > 0").join(of_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    without = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return with_words.union(without).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_per_group(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """The documents without near-duplicates of others: the one with the smallest id of each group, columns as they came.

    Of rows with the same words one stays; null ids come last. Texts without words all stay.
    """
    rows, labels = near_duplicate_classes(docs, size, percent)
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = labels.join(least, "node")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.isnull("least"), "least", "node")).alias("b")).select("root", "b.node")
    gone = stored(labels.join(best, ["root", "node"], "left_anti").select("node"), "gone")
    held = rows_held(docs)
    held = held.withColumns({"node": same_words(F.col("row.text")), "worded": F.col("row.text").rlike(f"[^{SPACES}]")})
    first = Window.partitionBy("node").orderBy(F.col("row.doc_id").asc_nulls_last())
    worded = held.where("worded").withColumn("k", F.row_number().over(first)).where("k = 1").join(gone, "node", "left_anti")
    return worded.select("row").union(held.where(~F.coalesce("worded", F.lit(False))).select("row")).select("row.*")
