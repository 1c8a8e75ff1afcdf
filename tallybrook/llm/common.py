"""What several operators share: reading, intermediate tables, words of Arrow text, token ids by distinct words."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import cache, wraps
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import work_folder

# White space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Latin letters and digits that no normalization turns into a letter with a mark.
LATIN = r"A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"

# A word that is one token run for the vocabulary's pre-tokenizer: of letters that no normalization changes.
LETTERS = r"^[a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"

# Text handled at once inside a task.
SLICE_BYTES = 4 << 20
# Distinct words whose token ids a worker remembers.
MEMO_WORDS = 300_000
# Words encoded at once, and what the last token of a run ends with.
ENCODED_WORDS, END_MARK = 1_000, "</w>"
# Bytes of rows that Spark hands to Python at once, unless the session says otherwise.
ARROW_BYTES = 4 << 20
ARROW_SETTING, ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to a table in the shared folder and read it back.

    Later steps start from the files, so they see the same rows however often they run,
    and nothing has to be computed again when an executor is lost.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def release() -> None:
    """Give memory that is no longer used back to the system; Spark keeps its Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc(), "malloc_trim"):
        libc().malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Let the session hand ``ARROW_BYTES`` to Python at once: documents are long, and the default is 64 MB for each task."""
    if spark.conf.get(ARROW_SETTING) == ARROW_DEFAULT:
        spark.conf.set(ARROW_SETTING, str(ARROW_BYTES))


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over small batches, whose memory the worker gives back when a task ends."""
    small_batches(df.sparkSession)

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def text_function(
    spark: SparkSession, make: Callable[[], Callable[[pa.Array], pa.Array]], kind: str, limit: int = SLICE_BYTES
) -> Callable[[Column], Column]:
    """A function of text columns: ``make`` is called once per task and gives what turns texts into values.

    Texts are taken ``limit`` bytes at a time.

    Only the text goes to Python and only the value comes back; the rest of the row stays where it is.
    """
    small_batches(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        try:
            for text in batches:
                parts = [function(part) for _, part in slices(text, text, limit)]
                yield pa.concat_arrays(parts) if parts else function(text)
        finally:
            del function
            release()

    # Named by hand, as the annotations are text in this module.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()


def rows_held(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that no added column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def slices(batch: pa.RecordBatch, text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(sizes)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a), text.slice(a, b - a)


def words_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, "").cast(pa.large_string()))
    flat = lists.flatten()
    row = pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False)
    return flat.filter(full), np.bincount(row[keep], minlength=len(text)).astype(np.int64)


def coded_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word codes of all texts one after another, and how many each text has."""
    flat, counts = words_of(text)
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def ascending(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; sorting beats hashing for whole numbers."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def tokenizer_for(path: str, memo_words: int = MEMO_WORDS) -> WordTokenizer:
    """The worker's own tokenizer of a vocabulary, loaded once and with what earlier tasks have learned."""
    return WordTokenizer(path, memo_words)


class WordTokenizer:
    """Token ids of whole texts, made by encoding each distinct word once.

    The vocabulary's normalizer lower-cases, and its pre-tokenizer parts letters and digits from
    what follows them and never joins characters across white space. So the ids of a text are
    those of its words in order, and a word's are those of its lower-cased body and of the
    punctuation after a Latin letter or digit at its end; tests hold this against encoding whole texts. When the memo is
    full, words met in one slice only are forgotten.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab()
        self.last = np.zeros(max(words.values()) + 1, bool)
        self.last[[i for word, i in words.items() if word.endswith(END_MARK)]] = True
        self.memo_words = memo_words
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.uint8)

    def _forget(self) -> None:
        """Keep the words met again; if these are too many, none."""
        words = np.array(list(self.known), object)
        stay = np.flatnonzero(self.met[: len(words)] > 1)
        if 2 * len(stay) > self.memo_words:
            stay = stay[:0]
        starts, lengths = self.ends[stay], self.ends[stay + 1] - self.ends[stay]
        ids, met = self.ids[spread(starts, lengths)], self.met[stay]
        self.known = dict(zip(words[stay].tolist(), range(len(stay)), strict=True))
        self.ids[: len(ids)] = ids
        self.ends[1 : len(stay) + 1] = np.cumsum(lengths)
        self.met[:] = 0
        self.met[: len(met)] = met

    def _encoded(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in the order encoded, the ids of all one after another, and how many each has.

        Words of letters alone are encoded as one text, where each is a run of its own and ends with the
        one token of it that bears the vocabulary's mark of an end. If the marks are not as many as the words, as of a
        vocabulary without them, each word is encoded by itself.
        """
        plain = pc.match_substring_regex(pa.array(words, pa.string()), LETTERS).to_numpy(zero_copy_only=False)
        done, ids, lengths = [], [], []
        for letters in (True, False):
            some = list(compress(words, (plain == letters).tolist()))
            for a in range(0, len(some), ENCODED_WORDS):
                part = some[a : a + ENCODED_WORDS]
                done += part
                if letters:
                    found = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
                    ends = np.flatnonzero(self.last[found]) + 1
                    if len(ends) == len(part):
                        ids.append(found)
                        lengths.append(np.diff(ends, prepend=0))
                        continue
                got = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                lengths.append(np.fromiter(map(len, got), np.int64, len(got)))
                ids.append(np.fromiter(chain.from_iterable(got), np.uint32, lengths[-1].sum()))
        return done, np.concatenate(ids), np.concatenate(lengths)

    def _learn(self, words: list[str]) -> np.ndarray:
        """The places of the words in the memo, after those not in it have been encoded."""
        known = self.known
        new = [w for w in words if w not in known]
        if new and len(known) + len(new) > self.memo_words:
            self._forget()
            known = self.known
            new = [w for w in words if w not in known]
        if new:
            new, ids, lengths = self._encoded(new)
            n, start = len(known), self.ends[len(known)]
            known.update(zip(new, range(n, n + len(new)), strict=True))
            self.ends, self.met = grown(self.ends, n + len(new) + 1), grown(self.met, n + len(new) + 1)
            self.ids = grown(self.ids, int(start + lengths.sum()))
            self.ids[start : start + len(ids)] = ids
            self.ends[n + 1 : n + 1 + len(new)] = start + np.cumsum(lengths)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.met[at] = np.minimum(self.met[at], 1) + 1
        return at

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        distinct, codes, counts = coded_words(text)
        parts = pc.extract_regex(distinct, rf"(?s)^(?P<body>.*[{LATIN}])(?P<tail>[.,;:!?*$%&#]+)$")
        body = pc.coalesce(pc.struct_field(parts, "body"), distinct)
        tail = pc.fill_null(pc.struct_field(parts, "tail"), "")
        body = pc.if_else(pc.match_substring(body, "<|"), body, pc.ascii_lower(body))
        both = pa.concat_arrays([body, tail]).dictionary_encode()
        at = self._learn(both.dictionary.to_pylist())[both.indices.to_numpy(zero_copy_only=False)]
        # The ids of each distinct word: its body's, then its tail's.
        at = at.reshape(2, -1).T.ravel()
        starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
        ids = self.ids[spread(starts, lengths)]
        of_word = lengths.reshape(-1, 2).sum(1)
        first = np.cumsum(of_word) - of_word
        per_word = of_word[codes]
        ids = ids[spread(first[codes], per_word)]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[bounds[1:]] - ends[bounds[:-1]]


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """The array, made longer by doubling until it has ``size`` places."""
    while len(values) < size:
        values = np.concatenate([values, np.zeros_like(values)])
    return values


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    ends = np.cumsum(lengths + 1)
    body = np.ones(len(out), bool)
    body[ends - 1] = False
    out[body] = ids
    return out, lengths + 1


def binary_column(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary value for each run of ``data``; runs follow each other without gaps."""
    width = data.dtype.itemsize
    offsets = np.concatenate([starts[:1] if len(starts) else [0], starts + lengths]).astype(np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())
