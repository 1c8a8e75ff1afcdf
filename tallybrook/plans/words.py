"""Word-count jobs on text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import SPACE, WHITE_RUN, pair_rows, word_rows
from tallybrook.operators.counting import count_by, count_by_digest
from tallybrook.operators.ordering import listing, top_k


def top_words(df: DataFrame, text: str = "value", k: int = 5, separator: str = SPACE) -> DataFrame:
    """The k most frequent words."""
    return top_k(count_by(word_rows(df, text, separator), "word"), k, "cnt", ["word"])


def word_listing(df: DataFrame, text: str = "value") -> DataFrame:
    """All words parted by white space, most frequent first."""
    return listing(count_by(word_rows(df, text, WHITE_RUN), "word"), "cnt", ["word"])


def digest_counts(df: DataFrame, text: str = "value", separator: str = SPACE) -> DataFrame:
    """Word counts under the MD5 digest of each word."""
    return count_by_digest(word_rows(df, text, separator), "word")


def pair_counts(lines: DataFrame, line: str = "value", separator: str = SPACE) -> DataFrame:
    """How often two words stand side by side in a line, keyed ``first-second``."""
    pairs = pair_rows(lines, line, separator).select(F.concat_ws("-", "first", "second").alias("pair"))
    return count_by(pairs, "pair")


def top_pairs(lines: DataFrame, line: str = "value", k: int = 5, separator: str = SPACE) -> DataFrame:
    """The k most frequent pairs of neighbouring words."""
    return top_k(pair_counts(lines, line, separator), k, "cnt", ["pair"])
