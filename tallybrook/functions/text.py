"""Splitting text into words and adjacent pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Patterns for `word_rows`: one blank, one blank or line end, a run of white space.
SPACE = " "
SPACE_OR_NEWLINE = "[ \n]"
WHITE_RUN = r"\s+"


def line_rows(df: DataFrame, text: str, name: str = "value") -> DataFrame:
    """One row per line of a text column."""
    return df.select(F.explode(F.split(text, "\n")).alias(name))


def word_rows(
    df: DataFrame,
    text: str = "value",
    separator: str = SPACE,
    keep_empty: bool = False,
    name: str = "word",
) -> DataFrame:
    """One row per word. Repeated separators give empty words, dropped unless asked for."""
    words = df.select(F.explode(F.split(text, separator)).alias(name))
    return words if keep_empty else words.where(F.col(name) != "")


def pair_rows(df: DataFrame, line: str = "value", separator: str = SPACE) -> DataFrame:
    """One row (first, second) per two neighbouring words of a line.

    Empty words go before pairing, so a pair never holds one and never spans lines.
    """
    words = df.select(F.array_remove(F.split(line, separator), "").alias("words"))
    pairs = F.greatest(F.size("words") - 1, F.lit(0))
    both = F.arrays_zip(F.slice("words", 1, pairs), F.slice("words", 2, pairs))
    return words.select(F.inline(both).alias("first", "second"))
