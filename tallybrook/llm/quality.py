"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated, a posterior decides."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import coded_words, rows_held, stored, text_function

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50
KEEP_FROM = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alnum", "n_upper")


def repeated_words(codes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in their text, for each of ``n`` texts.

    ``codes`` are the words of all texts, ``row`` the text of each. Windows are sorted by a mix of
    text and words, and neighbours compared in full.
    """
    if len(codes) < 4:
        return np.zeros(n, np.int64)
    parts = np.stack([row[:-2], codes[:-2], codes[1:-1], codes[2:]]).astype(np.uint64)
    key = np.zeros(parts.shape[1], np.uint64)
    for x in parts:
        key = (key ^ x) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(row[:-2] == row[2:])
    at = at[np.argsort(key[at])]
    alike = np.flatnonzero(key[at[1:]] == key[at[:-1]])
    alike = alike[(parts[:, at[alike + 1]] == parts[:, at[alike]]).all(0)]
    covered = np.zeros(len(codes), bool)
    for found in (at[alike], at[alike + 1]):
        for k in range(3):
            covered[found + k] = True
    return np.bincount(row[covered], minlength=n).astype(np.int64)


def duplicate_lines(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those among them equal to an earlier one, per text."""
    lists = pc.split_pattern(text, "\n")
    lines, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)
    row = row[worded.to_numpy(zero_copy_only=False)]
    code = lines.filter(worded).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    all_lines = np.bincount(row, minlength=n)
    different = np.unique(row * (int(code.max()) + 1 if len(code) else 1) + code)
    once = np.bincount(different // (int(code.max()) + 1 if len(code) else 1), minlength=n)
    return all_lines, all_lines - once


def text_counts(text: pa.Array) -> list[np.ndarray]:
    """``COUNTS`` of each text; a null text counts as empty."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    distinct, codes, counts = coded_words(text)
    n = len(text)
    row = np.repeat(np.arange(n), counts)

    def summed(per_word: pa.Array) -> np.ndarray:
        values = per_word.to_numpy(zero_copy_only=False).astype(np.int64)
        return np.bincount(row, weights=values[codes], minlength=n).astype(np.int64)

    lower, upper = pc.utf8_lower(distinct), pc.utf8_upper(distinct)
    alnum = pc.utf8_length(pc.replace_substring_regex(distinct, r"[^\pL\pN]", ""))
    # A word that lower-casing changes and upper-casing does not is in capitals.
    capital = pc.and_(pc.not_equal(lower, distinct), pc.equal(upper, distinct))
    lines, duplicates = duplicate_lines(text, n)
    symbols = pc.count_substring_regex(text, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)
    return [
        counts,
        summed(pc.utf8_length(distinct)),
        symbols,
        duplicates,
        repeated_words(codes, row, n),
        lines,
        summed(alnum),
        summed(pc.if_else(capital, alnum, pa.scalar(0, alnum.type))),
    ]


def quality_counts(docs: DataFrame) -> DataFrame:
    """(row, counts): each document with what the rules look at, over its whole text.

    ``docs`` needs ``text``; all columns stay inside ``row``. A null text counts as empty;
    repeated rows are documents of their own; an empty table gives an empty one.
    """

    def make() -> Callable[[pa.Array], pa.Array]:
        return lambda text: pa.StructArray.from_arrays([pa.array(x) for x in text_counts(text)], names=list(COUNTS))

    counts = text_function(docs.sparkSession, make, f"struct<{', '.join(f'{c}: long' for c in COUNTS)}>")
    return rows_held(docs).select("row", counts(F.col("row.text").cast("string")).alias("counts"))


def base_failed(c: Column) -> Column:
    """Too short, or more than half of the words repeated."""
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


@dataclass(frozen=True)
class Rule:
    """Votes against a text where ``bad`` holds, for it where ``good`` holds, else not at all."""

    name: str
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]


# Each rule looks at one trait, ``c`` being the counts: shares of words, characters in words, or lines.
RULES = (
    Rule("length", lambda c: c["n_words"] < 50, lambda c: c["n_words"] >= 100),
    Rule(
        "symbols",
        lambda c: c["n_symbols"] > 0.05 * c["word_chars"],
        lambda c: c["n_symbols"] <= 0.01 * c["word_chars"],
    ),
    Rule(
        "repetition",
        lambda c: c["n_repeat_words"] > 0.3 * c["n_words"],
        lambda c: c["n_repeat_words"] <= 0.1 * c["n_words"],
    ),
    Rule(
        "lines",
        lambda c: c["n_dup_lines"] > 0.3 * c["n_lines"],
        lambda c: c["n_dup_lines"] <= 0.1 * c["n_lines"],
    ),
    Rule(
        "marks",
        lambda c: c["n_alnum"] < 0.91 * c["word_chars"],
        lambda c: c["n_alnum"] >= 0.93 * c["word_chars"],
    ),
    Rule(
        "capitals",
        lambda c: c["n_upper"] > 0.5 * c["n_alnum"],
        lambda c: c["n_upper"] <= 0.2 * c["n_alnum"],
    ),
    Rule(
        "words",
        lambda c: (c["word_chars"] < 2.5 * c["n_words"]) | (c["word_chars"] > 12 * c["n_words"]),
        lambda c: c["word_chars"].between(3 * c["n_words"], 10 * c["n_words"]),
    ),
)


def votes(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All votes in one number, a digit of base 3 per rule: 0 against, 1 abstained, 2 for."""
    pattern = F.lit(0)
    for k, rule in enumerate(rules):
        pattern = pattern + F.when(rule.bad(counts), 0).when(rule.good(counts), 2).otherwise(1) * 3**k
    return pattern


def fit_votes(patterns: dict[int, int], rules: int = len(RULES), rounds: int = 200) -> dict[int, float]:
    """The probability of good quality for each pattern of votes, by expectation-maximisation.

    Two hidden classes; within a class a rule that votes says "good" with a probability of its
    own, independently of the others; a rule that abstains says nothing. It starts from the
    suspicion that a text with a vote against it is bad. Estimates are smoothed by one vote
    of either kind, so they stay inside (0, 1). Without a vote against any text all are good.
    """
    keys = np.array(sorted(patterns), np.int64)
    weight = np.array([patterns[k] for k in keys.tolist()], float)
    digits = keys[:, None] // 3 ** np.arange(rules) % 3
    yes, no = (digits == 2).astype(float), (digits == 0).astype(float)
    good = np.where(no.any(1), 0.1, 0.99)
    for _ in range(rounds):
        share = np.clip((weight @ good + 1) / (weight.sum() + 2), 0.01, 0.99)
        logs = []
        for belief in (good, 1 - good):
            w = weight * belief
            p = (w @ yes + 1) / (w @ yes + w @ no + 2)
            logs.append(yes @ np.log(p) + no @ np.log(1 - p))
        odds = np.log(share / (1 - share)) + logs[0] - logs[1]
        new = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        done = np.abs(new - good).max() < 1e-9 if len(new) else True
        good = new
        if done:
            break
    if len(keys) and not no.any():
        good = np.ones(len(keys))
    return dict(zip(keys.tolist(), good.tolist(), strict=True))


def judged(counted: DataFrame, fitted_on: DataFrame | None = None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``counted`` with ``base_failed``, ``p_good`` and ``kept``.

    The votes of all documents of ``fitted_on`` (the same rows by default) are counted by
    pattern; these counts, 3 to the number of rules at most, are what the driver fits.
    A text that fails the base rules is not kept, whatever its votes. Without rows there is nothing to
    fit, and no result.
    """
    source = counted if fitted_on is None else fitted_on
    found = source.select(votes(F.col("counts")).alias("pattern")).groupBy("pattern").count().collect()
    posterior = fit_votes({int(r["pattern"]): int(r["count"]) for r in found})
    table = F.create_map(*[F.lit(x) for pair in posterior.items() for x in pair]) if posterior else F.lit(None)
    p_good = F.element_at(table, votes(F.col("counts"))) if posterior else F.lit(None).cast("double")
    failed = base_failed(F.col("counts"))
    return counted.withColumns({"base_failed": failed, "p_good": p_good}).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("p_good"), F.lit(0.0)) >= keep_from)
    )


def keep_good(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents of good quality, with their columns as they came.

    Texts are counted once, into a table in the shared folder. Null and empty texts fail; repeated rows are judged each
    alike and all kept or none; without documents there is no result.
    """
    return judged(stored(quality_counts(docs), "quality"), keep_from=keep_from).where("kept").select("row.*")
