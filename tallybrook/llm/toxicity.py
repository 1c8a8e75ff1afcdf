"""Toxicity through a noisy channel: obfuscated words are restored under a character model, then texts are scored."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import SPACES, ascending, coded_words, map_batches, rows_held, slices, stored, text_function, words_of
from tallybrook.llm.near_dups import same_words

THRESHOLD = 0.3
# Labelled rows that the classifier is fitted on at most, those with the smallest hashes of their ids.
LABELLED_ROWS = 50_000
# Features that the classifier keeps at most, those whose texts are most surely toxic.
FEATURES = 20_000
# Odd words whose readings a task remembers.
MEMO_WORDS = 100_000
# Squared standard errors by which a feature's share of toxic texts is lowered, and the least such share.
CAUTION, LEAST_SHARE = 12.0, 0.25
PREFIXES = (3, 4, 5, 6)
# Fitting: the penalty of a squared weight, steps, and their size.
PENALTY, STEPS, RATE = 0.5, 400, 0.3

# Characters of the model: a-z, the edge of a word, and classes of other letters.
EDGE, OTHERS = 26, 32
LETTERS = EDGE + 1 + OTHERS
# Text whose features are made at once.
FEATURE_BYTES = 2 << 20
# Words of a task are summed up when so many have gathered.
GATHERED = 500_000

# Letters that a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Costs in nats: a stand-in, a stand-in that means nothing, another sign inside a word, a shortened repetition, a
# character written twice for one.
STAND_IN, IDLE_STAND_IN, SIGN, SHORTENED, DOUBLED = 0.5, 6.0, 0.1, 0.2, 4.0
# Single characters one after another that make up a spaced word.
SPACED = 4
# Lengths of the prefixes that are taken from every letter of a run of spaced characters.
STARTS = (4, 5, 6)

# Around a word: signs, with $$ and @@ at its end, which may be noise or letters; and without these.
EDGES = re.compile(r"^(?:[^\w$@!]|_)+|(?:[^\w$@]|_|([$@])\1+)+$")
SIGNS_AROUND = re.compile(r"^(?:[^\w$@!]|_)+|(?:[^\w$@]|_)+$")
TWICE = re.compile(r"(.)\1", re.DOTALL)


def letter_codes(text: str) -> list[int]:
    return [ord(c) - 97 if "a" <= c <= "z" else EDGE + 1 + ord(c) % OTHERS for c in text]


# The character model.


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the lower-cased runs of letters of all texts. Tasks sum up before anything moves."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, text in slices(batch, batch.column("text")):
                flat, _ = words_of(text)
                plain = pc.utf8_trim(pc.utf8_lower(flat), ".,;:!?\"'()")
                found = plain.value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                size += len(found)
                if size > GATHERED:
                    held = [summed(held)]
                    size = held[0].num_rows
                    if 2 * size > GATHERED:
                        yield from held[0].cast(out).to_batches()
                        held, size = [], 0
        if held:
            yield from summed(held).cast(out).to_batches()

    def summed(tables: list[pa.Table]) -> pa.Table:
        """The sums have the types of what is summed, as they are summed again with what comes next."""
        sums = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        sums = sums.filter(pc.match_substring_regex(sums["word"], r"^\pL+$"))
        return pa.table({"word": sums["word"], "n": sums["n_sum"]})

    out = pa.schema([("word", pa.string()), ("n", pa.int64())])

    rows = map_batches(docs.select(F.col("text").cast("string").alias("text")), counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def letter_model(words: DataFrame) -> np.ndarray:
    """Log probabilities of a letter after two others, from the letters of all words as often as they occur.

    Trigrams are counted where the words are; their table, as large as its alphabet allows, is
    what the driver gets. Shares of trigrams, bigrams and letters are interpolated.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
            codes = [[EDGE, EDGE, *letter_codes(w), EDGE] for w in words]
            lengths = np.fromiter(map(len, codes), np.int64, len(codes))
            flat = np.fromiter((c for w in codes for c in w), np.int64, int(lengths.sum()))
            ends = np.cumsum(lengths)
            inside = np.ones(len(flat), bool)
            inside[(ends[:, None] - lengths[:, None] + [0, 1]).ravel()] = False
            at = np.flatnonzero(inside)
            trigrams = (flat[at - 2] * LETTERS + flat[at - 1]) * LETTERS + flat[at]
            table += np.bincount(trigrams, weights=np.repeat(n, lengths - 2), minlength=len(table)).astype(np.int64)
        found = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(table[found])], names=["trigram", "n"])

    sums = map_batches(words, counted, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**3)
    counts[sums["trigram"].to_numpy(np.int64)] = sums["n"].to_numpy(float)
    counts = counts.reshape(LETTERS, LETTERS, LETTERS)
    two = counts.sum(0)
    one = counts.sum((0, 1)) + 1
    one /= one.sum()
    share2 = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    share3 = (counts + 5 * share2[None]) / (counts.sum(2, keepdims=True) + 5)
    return np.log(0.9 * share3 + 0.1 * share2[None]).astype(np.float32)


# The channel.


def ways(char: str, times: int, doubled: float = DOUBLED) -> list[tuple[str, float]]:
    """The letters that a run of one character may come from, and what each reading costs."""
    if char.isalpha():
        if times > 2:
            return [(char, SHORTENED), (char * 2, SHORTENED)]
        return [(char * times, 0.0)] + [(char, doubled)] * (times == 2)
    if char in STANDS_FOR:
        numbers = {1: [(1, 0.0)], 2: [(2, 0.0), (1, doubled)]}.get(times, [(1, 0.0), (2, 0.0)])
        return [(c * k, STAND_IN * k + cost) for c in STANDS_FOR[char] for k, cost in numbers] + [("", IDLE_STAND_IN)]
    return [("", SIGN)]


def restore(word: str, model: np.ndarray | list, spaced: bool = False) -> str:
    return likeliest(word, model, spaced)[1]


def readings(word: str, model: np.ndarray | list) -> tuple[str, str]:
    """The likeliest letters behind a word with signs around it, and those of its other reading.

    ``$$`` or ``@@`` at the end may be noise or letters, digits without a letter a number or letters,
    and of characters written twice one may be meant, however common both are; other words have
    one reading, given twice.
    """
    whole, cut = SIGNS_AROUND.sub("", word), EDGES.sub("", word)
    if not any(map(str.isalpha, word)) and any(map(str.isnumeric, word)):
        return word, restore(whole, model)
    if whole == cut:
        best = restore(whole, model)
        return best, likeliest(whole, model, doubled=0.0)[1] if TWICE.search(whole) else best
    as_letters, as_noise = likeliest(whole, model), likeliest(cut, model)
    # A word has letters, however cheap none are.
    best, other = sorted((as_letters, as_noise), key=lambda x: (not x[1], x[0]))
    return best[1], other[1]


def likeliest(word: str, model: np.ndarray | list, spaced: bool = False, doubled: float = DOUBLED) -> tuple[float, str]:
    """The cost and letters of the likeliest reading of a lower-cased word: Viterbi's search over the last two letters.

    With ``spaced`` the characters are those of several words; a space is put wherever it is
    likelier that a word ends and another begins.
    """
    # The cost of each state, and its letters as a chain from the last ones back.
    states = {(EDGE, EDGE): (0.0, ())}
    for char, run in groupby(word):
        found: dict[tuple[int, int], tuple[float, tuple]] = {}
        meant = ways(char, len(list(run)), doubled)
        if spaced:
            meant = [(text, cost) for letters, cost in meant for text in parted(letters)]
        options = [(text, [EDGE if c == " " else letter_codes(c)[0] for c in text], cost) for text, cost in meant]
        for (a, b), (before, chain) in states.items():
            for letters, codes, cost in options:
                x, y, total = a, b, before + cost
                for c in codes:
                    total -= float(model[x][y][c])
                    x, y = (y, c) if c != EDGE else (EDGE, EDGE)
                if (x, y) not in found or total < found[x, y][0]:
                    found[x, y] = (total, (chain, letters))
        states = found
    # After a space the last word has ended.
    ends = [(total - (float(model[a][b][EDGE]) if b != EDGE or not spaced else 0.0), chain) for (a, b), (total, chain) in states.items()]
    cost, chain = min(ends, key=lambda end: end[0])
    out = []
    while chain:
        chain, letters = chain
        out.append(letters)
    return cost, "".join(reversed(out)).strip(" ")


def parted(letters: str) -> list[str]:
    """One or two letters with and without the end of a word after each."""
    out = [""]
    for c in letters:
        out = [before + c + end for before in out for end in ("", " ")]
    return out


def letter_options(word: str) -> list[tuple[str, float, int]]:
    """The readings of a word of letters: each run of one letter stands for itself or is shortened.

    With each reading go its cost but for letters written twice, and how many of these are read as one.
    """
    first = TWICE.search(word)
    if first and not TWICE.search(word, first.end() - 1):
        # Most have one letter twice.
        return [(word, 0.0, 0), (word[: first.start()] + word[first.start() + 1 :], 0.0, 1)]
    out = [("", 0.0, 0)]
    for char, run in groupby(word):
        times = len(list(run))
        if times == 1:
            out = [(text + char, cost, twice) for text, cost, twice in out]
        elif times == 2:
            out = [(text + c, cost, twice + one) for text, cost, twice in out for c, one in ((char * 2, 0), (char, 1))]
        else:
            out = [(text + c, cost + SHORTENED, twice) for text, cost, twice in out for c in (char, char * 2)]
    return out


def letter_readings(words: list[str], model: np.ndarray) -> list[tuple[str, str]]:
    """What `readings` gives, for many words of letters at once: all their readings are few enough to be written out."""
    options = [letter_options(word) for word in words]
    texts, costs, twice = [list(x) for x in zip(*chain.from_iterable(options), strict=True)] or [[], [], []]
    costs, twice = np.array(costs, float), np.array(twice, float)
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 97, EDGE + 1 + points % OTHERS)
    end = points == 10
    codes[end] = EDGE
    # The two letters before each; the edge before the first of a word.
    start = np.concatenate([[True], end[:-1]]) if len(end) else end
    one = np.where(start, EDGE, np.roll(codes, 1))
    two = np.where(start | np.roll(start, 1), EDGE, np.roll(codes, 2))
    first = np.flatnonzero(start)
    if len(first):
        costs = costs - np.add.reduceat(model[two, one, codes].astype(np.float64), first)
    lengths = np.fromiter(map(len, options), np.int64, len(options))
    of = np.repeat(np.arange(len(options)), lengths)
    before = np.cumsum(lengths) - lengths
    best = np.lexsort((costs + DOUBLED * twice, of))[before]
    other = np.lexsort((costs, of))[before]
    return [(texts[a], texts[b]) for a, b in zip(best.tolist(), other.tolist(), strict=True)]


# Runs of several letters in a word whose readings are written out; words with more go through the search.
RUNS = 5
LONG_RUN = re.compile(r"(.)\1+", re.DOTALL)
# What makes a word of letters worth a look: two letters alike, or one for which that is not said here.
COMMON = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
MAY_BE_TWICE = f"[^{COMMON}]|" + "|".join(f"{c}{c}" for c in COMMON)
STAND_IN_OR_LETTER = r"\pL|[" + "".join(re.escape(c) for c in STANDS_FOR) + "]"


def plain_words(words: pa.Array, model: Model, memo: dict[str, tuple[str, str]]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Each word lower-cased without the signs around it, what is restored from it, and its other reading."""
    lower = pc.utf8_lower(words)
    body = pc.replace_substring_regex(lower, r"^[^\pL\pN$@!]+|[^\pL\pN$@]+$", "").cast(pa.large_string())
    simple = pc.match_substring_regex(body, r"^\pL*$")
    # Signs among letters, signs or digits that stand for letters, or two letters alike.
    odd = pc.if_else(simple, pc.match_substring_regex(body, MAY_BE_TWICE), pc.match_substring_regex(body, STAND_IN_OR_LETTER))
    found: list[tuple[str, str] | None] = []
    doubled, places = [], []
    for k, (word, only_letters) in enumerate(zip(body.filter(odd).to_pylist(), simple.filter(odd).to_pylist(), strict=True)):
        known = memo.get(word)
        if known is None:
            if only_letters and len(LONG_RUN.findall(word)) <= RUNS:
                doubled.append(word)
                places.append(k)
            else:
                known = memo[word] = readings(word, model.nested)
        found.append(known)
    for k, word, both in zip(places, doubled, letter_readings(doubled, model.table), strict=True):
        found[k] = memo[word] = both
    if len(memo) > MEMO_WORDS:
        # The words of this part are likeliest to come again.
        now = set(body.filter(odd).to_pylist())
        stay = {word: both for word, both in memo.items() if word in now}
        memo.clear()
        memo.update(stay if 2 * len(stay) <= MEMO_WORDS else {})
    best, other = ([both[side] for both in found] for side in (0, 1))
    return body, *(pc.replace_with_mask(body, odd, pa.array(x, pa.large_string())) for x in (best, other))


# Features: a whole word, and its first letters.


def feature_hashes(words: pa.Array) -> list[np.ndarray]:
    """For each word the hashes of its features; words too short for a prefix have that of the empty text."""
    return [pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False), *prefix_hashes(words, PREFIXES)]


def prefix_hashes(words: pa.Array, lengths: tuple[int, ...]) -> list[np.ndarray]:
    out = []
    for k in lengths:
        cut = pc.if_else(pc.greater_equal(pc.utf8_length(words), k), pc.utf8_slice_codeunits(words, 0, k), "")
        coded = cut.dictionary_encode()
        values = coded.dictionary.to_numpy(zero_copy_only=False)
        hashes = pd.util.hash_array(np.array([f"{v}*" for v in values], object), categorize=False)
        out.append(hashes[coded.indices.to_numpy(zero_copy_only=False)])
    return out


def spaced_words(single: np.ndarray, codes: np.ndarray, counts: np.ndarray, chars: np.ndarray) -> list[tuple[int, int, str]]:
    """(text, place of its first word, letters) of each run of single characters."""
    row = np.repeat(np.arange(len(counts)), counts)
    alone = single[codes]
    if not alone.any():
        return []
    first = np.cumsum(counts) - counts
    at = np.flatnonzero(alone)
    cuts = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0)) + 1
    starts = np.concatenate([[0], cuts])
    lengths = np.diff(np.concatenate([starts, [len(at)]]))
    found = []
    for a, n in zip(at[starts[lengths >= SPACED]].tolist(), lengths[lengths >= SPACED].tolist(), strict=True):
        found.append((int(row[a]), int(a - first[row[a]]), "".join(chars[codes[a : a + n]])))
    return found


def spaced_hashes(spaced: list[tuple[int, int, str, str]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of features, and their rows: of the words of each run, of all its letters, and of the letters from each
    one on, should an end of a word be missed."""
    words, word_rows, starts, start_rows = [], [], [], []
    for row, _, _, restored in spaced:
        own, letters = set(restored.split(" ")), restored.replace(" ", "")
        words += [*own, letters]
        word_rows += [row] * (len(own) + 1)
        from_each = {letters[k : k + STARTS[-1]] for k in range(len(letters) - STARTS[0] + 1)}
        starts += from_each
        start_rows += [row] * len(from_each)
    hashes = feature_hashes(pa.array(words, pa.large_string()))
    more = prefix_hashes(pa.array(starts, pa.large_string()), STARTS)
    return hashes + more, [np.array(word_rows, np.int64)] * len(hashes) + [np.array(start_rows, np.int64)] * len(more)


class Model:
    """The letter model as an array, and as nested lists, which give single values faster."""

    def __init__(self, table: np.ndarray):
        self.table, self.nested = table, table.tolist()


class Features:
    """The features of texts, and with a table of scores the best score of each text."""

    def __init__(self, model: np.ndarray):
        self.model, self.memo = Model(model), {}

    def of(self, text: pa.Array) -> tuple[list[tuple[np.ndarray, list[np.ndarray]]], np.ndarray, list[tuple[int, int, str, str]]]:
        """(words, hashes) of each form: as written, restored, other reading; (text, word) pairs, and spaced words with what is restored."""
        distinct, codes, counts = coded_words(text)
        body, restored, other = plain_words(distinct, self.model, self.memo)
        row = np.repeat(np.arange(len(text)), counts)
        pairs = ascending(row * max(1, len(distinct)) + codes)
        short = pc.equal(pc.utf8_length(body), 1).to_numpy(zero_copy_only=False)
        spaced = spaced_words(short, codes, counts, body.to_numpy(zero_copy_only=False))
        spaced = [(r, at, w, restore(w, self.model.nested, spaced=True)) for r, at, w in spaced]
        self.spaced = spaced
        self.changed = pc.not_equal(body, restored).to_numpy(zero_copy_only=False)
        self.distinct = distinct, restored
        forms = [(np.ones(len(body), bool), feature_hashes(body))]
        two = pc.not_equal(restored, other).to_numpy(zero_copy_only=False)
        for words, new in ((restored, self.changed), (other, two)):
            if new.any():
                at = np.flatnonzero(new)
                forms.append((new, [widened(h, at, len(new)) for h in feature_hashes(words.take(pa.array(at)))]))
        return forms, pairs, spaced


def widened(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """An array of ``size`` places with the values at the given ones."""
    out = np.zeros(size, values.dtype)
    out[at] = values
    return out


def text_features(features: Features, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature) of a batch of texts, each pair once; and the rows that hold a changed word or spaced ones."""
    forms, pairs, spaced = features.of(text)
    n = max(1, len(features.changed))
    row, word = pairs // n, pairs % n
    hashes, rows = [], []
    for new, own in forms:
        here = new[word]
        hashes += [h[word[here]] for h in own]
        rows += [row[here]] * len(own)
    if spaced:
        own, own_rows = spaced_hashes(spaced)
        hashes += own
        rows += own_rows
    hash_, row_ = np.concatenate(hashes), np.concatenate(rows)
    return hash_, row_, ascending(np.concatenate([row[features.changed[word]], np.array([r for r, *_ in spaced], np.int64)]))


def distinct_pairs(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((rows, hashes))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def known_pairs(hashes: np.ndarray, rows: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``known``, row) of the features that are known, each pair once."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    return distinct_pairs(at[hit], rows[hit])


def labelled_features(docs: DataFrame, model, made: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """What ``made`` gives for the features of labelled texts, some texts at once: (hash, text) pairs, each once and by
    hash, and the texts' labels. It is called where the features are, so a task has one Python worker."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.value)
        for batch in batches:
            for part, text in slices(batch, batch.column("text"), FEATURE_BYTES):
                hashes, rows, _ = text_features(features, text)
                yield made(*distinct_pairs(hashes, rows), part.column("toxic"))

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    return map_batches(rows, hashed, schema)


def feature_counts(docs: DataFrame, model) -> DataFrame:
    """(feature, pos, neg): in how many labelled texts of either label a feature occurs, restored words included."""

    def counted(hashes: np.ndarray, rows: np.ndarray, labels: pa.Array) -> pa.RecordBatch:
        toxic = labels.to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        found, at = np.unique(hashes, return_inverse=True)
        pos = np.bincount(at, weights=toxic, minlength=len(found)).astype(np.int64)
        neg = np.bincount(at, minlength=len(found)) - pos
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(pos), pa.array(neg)], names=["feature", "pos", "neg"]
        )

    rows = labelled_features(docs, model, counted, "feature long, pos long, neg long")
    return rows.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def known_features(docs: DataFrame, model, known) -> DataFrame:
    """(toxic, found): the places of each labelled text's known features."""

    def found(hashes: np.ndarray, rows: np.ndarray, labels: pa.Array) -> pa.RecordBatch:
        places, rows = known_pairs(hashes, rows, known.value)
        order = np.argsort(rows, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(labels)))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places[order], pa.int32()))
        return pa.RecordBatch.from_arrays([labels, lists], names=["toxic", "found"])

    return labelled_features(docs, model, found, "toxic int, found array<int>")


def fit_weights(toxic: np.ndarray, row: np.ndarray, place: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a quadratic penalty, by gradient steps scaled to each weight's own gradients."""
    weights, bias = np.zeros(features), 0.0
    sums, bias_sum = np.full(features, 1e-9), 1e-9
    for _ in range(STEPS if len(toxic) else 0):
        z = bias + np.bincount(row, weights=weights[place], minlength=len(toxic))
        off = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - toxic
        slope = np.bincount(place, weights=off[row], minlength=features) + PENALTY * weights
        sums += slope**2
        bias_sum += off.sum() ** 2
        weights -= RATE * slope / np.sqrt(sums)
        bias -= RATE * off.sum() / np.sqrt(bias_sum)
    return weights, bias if len(toxic) else -5.0


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id is not held out, having no label."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame) -> tuple:
    """(character model, features, weights and bias), broadcast and of bounded size.

    The character model is made from all texts. The classifier sees ``LABELLED_ROWS`` labelled rows
    that are not held out; of texts with the same words one counts. Features are those whose
    share of toxic texts has a high lower bound (Wilson's interval), so a rare one needs more
    than chance; their weights come from a logistic regression. Labels that are null, or of no
    document, do nothing; of labels of one id that contradict each other the toxic one counts; without
    labels all texts score alike. The labelled texts are decoded twice; their features would take more disk than the texts.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(letter_model(word_counts(docs)))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    nodes = texts.join(F.broadcast(known), "doc_id").select("doc_id", "toxic", same_words(F.col("text")).alias("node"))
    once = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "toxic")).alias("of")).select("of.*").distinct()
    once = stored(once.limit(LABELLED_ROWS), "labelled")
    train = texts.join(F.broadcast(once), "doc_id").select("text", "toxic")
    counts = feature_counts(train, model).where("pos > 2")
    n, share = F.col("pos") + F.col("neg"), F.col("pos") / (F.col("pos") + F.col("neg"))
    spread = F.sqrt(CAUTION * (share * (1 - share) / n + CAUTION / (4 * n * n)))
    low = (share + CAUTION / (2 * n) - spread) / (1 + CAUTION / n)
    best = counts.select("feature", low.alias("low")).where(F.col("low") > LEAST_SHARE)
    best = best.orderBy(F.desc("low"), "feature").limit(FEATURES).select("feature").toPandas()
    features = spark.sparkContext.broadcast(np.sort(best["feature"].to_numpy(np.int64).view(np.uint64)))
    seen = known_features(train, model, features).toPandas()
    found = [np.asarray(x, np.int64) for x in seen["found"]]
    row = np.repeat(np.arange(len(found)), [len(x) for x in found])
    place = np.concatenate([*found, np.zeros(0, np.int64)])
    weights = fit_weights(seen["toxic"].to_numpy(float), row, place, len(features.value))
    return model, features, weights


def toxicity(docs: DataFrame, fitted: tuple, restored: bool = False) -> DataFrame:
    """(row, score) of every document, and ``restored`` if asked for.

    ``score`` is the classifier's probability from the features of the whole text, in its own and
    in its restored words; null and empty texts have none and score as such. ``restored`` is the
    text with restored words where these differ and spaced words joined, else null. ``docs`` needs ``text``; all columns
    stay inside ``row``, and nothing but the text is looked at. Repeated rows score alike; an empty table gives
    an empty one.
    """
    model, known, (weights, bias) = fitted

    def make() -> Callable[[pa.Array], pa.Array]:
        features = Features(model.value)

        def scored(text: pa.Array) -> pa.Array:
            hashes, rows, changed = text_features(features, text)
            places, rows = known_pairs(hashes, rows, known.value)
            z = bias + np.bincount(rows, weights=weights[places], minlength=len(text))
            scores = pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))
            if not restored:
                return scores
            return pa.StructArray.from_arrays([scores, restored_texts(text, features, changed)], names=["score", "restored"])

        return scored

    kind = "struct<score: double, restored: string>" if restored else "double"
    found = text_function(docs.sparkSession, make, kind, FEATURE_BYTES)(F.col("row.text").cast("string"))
    rows = rows_held(docs).select("row", found.alias("score"))
    return rows.select("row", "score.score", "score.restored") if restored else rows


def restored_texts(text: pa.Array, features: Features, rows: np.ndarray) -> pa.Array:
    """The texts of the given rows with each changed word, and each run of spaced characters, replaced by what is restored."""
    out: list[str | None] = [None] * len(text)
    if len(rows):
        words, restored = features.distinct
        at = np.flatnonzero(features.changed)
        new = dict(zip(words.take(pa.array(at)).to_pylist(), restored.take(pa.array(at)).to_pylist(), strict=True))
        runs: dict[int, dict[int, tuple[int, str]]] = {}
        for i, first, letters, found in features.spaced:
            runs.setdefault(i, {})[first] = (len(letters), found)
        for i in rows.tolist():
            whole, parts, end, inside = text[i].as_py(), [], 0, 0
            own = runs.get(i, {})
            for k, m in enumerate(re.finditer(f"[^{SPACES}]+", whole)):
                if k < inside:
                    end = m.end()
                    continue
                n, found = own.get(k, (1, new.get(m[0], m[0])))
                parts += [whole[end : m.start()], found]
                end, inside = m.end(), k + n
            out[i] = "".join([*parts, whole[end:]])
    return pa.array(out, pa.string())


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with their columns as they came.

    Null and empty texts have no features and stay; repeated rows stay or go alike; without labels all
    stay, and without documents there is no result.
    """
    return toxicity(docs, fit(docs, labels)).where(F.col("score") < threshold).select("row.*")
