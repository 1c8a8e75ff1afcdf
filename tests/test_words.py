from collections import Counter

import pytest

from tallybrook.functions.text import SPACE_OR_NEWLINE, WHITE_RUN, line_rows, pair_rows, word_rows
from tallybrook.operators.counting import count_by, count_by_digest, weighted_count, weighted_count_from
from tallybrook.operators.ordering import top_k
from tallybrook.plans.streams import running_word_count
from tallybrook.plans.words import digest_counts, pair_counts, top_pairs, top_words, word_listing
from tallybrook.sources.files import read_lines, write_pairs

TEXT = [
    "Spark is fast and Spark is fun",
    "  two  blanks lead ",
    "",
    "tab\there Spark",
    "one",
    "to be or not to be",
]


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "text.txt").write_text("\n".join(TEXT) + "\n")
    return read_lines(spark, str(tmp_path / "text.txt"))


def expected(split):
    return Counter(w for line in TEXT for w in split(line) if w)


def test_words_by_one_space(lines, rows):
    assert dict(rows(count_by(word_rows(lines), "word"))) == expected(lambda s: s.split(" "))


def test_words_by_white_space(lines, rows):
    assert dict(rows(word_listing(lines))) == expected(str.split)


def test_empty_words_are_kept_on_request(lines, rows):
    counts = dict(rows(running_word_count(lines)))
    assert counts[""] == sum(s.split(" ").count("") for s in TEXT)


def test_listing_is_ordered(lines):
    listed = [(r["cnt"], r["word"]) for r in word_listing(lines).collect()]
    assert listed == sorted(listed, key=lambda r: (-r[0], r[1]))


def test_top_words_break_ties_by_word(lines):
    best = [tuple(r) for r in top_words(lines, k=5).collect()]
    ranked = sorted(expected(lambda s: s.split(" ")).items(), key=lambda r: (-r[1], r[0]))
    assert best == ranked[:5]


def test_digest_keys(lines, rows):
    counts = dict(rows(digest_counts(lines)))
    assert counts["8cde774d6f7333752ed72cacddb05126"] == 3  # Spark
    assert len(counts) == len(expected(lambda s: s.split(" ")))


def test_digest_merges_equal_digests(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "word string")
    assert sorted(r[1] for r in rows(count_by_digest(df, "word"))) == [1, 2]


def test_weights(lines, spark, rows):
    found = word_rows(lines)
    plain = dict(rows(count_by(found, "word")))
    weighted = dict(rows(weighted_count(found, "word", {"Spark": 2})))
    assert weighted["Spark"] == 2 * plain["Spark"]
    assert {w: c for w, c in weighted.items() if w != "Spark"} == {w: c for w, c in plain.items() if w != "Spark"}
    table = spark.createDataFrame([("Spark", 2), ("absent", 9)], "word string, weight int")
    assert dict(rows(weighted_count_from(found, "word", table))) == weighted


def test_pairs(lines, rows):
    pairs = Counter()
    for line in TEXT:
        words = [w for w in line.split(" ") if w]
        pairs.update(f"{a}-{b}" for a, b in zip(words, words[1:]))
    assert dict(rows(pair_counts(lines))) == pairs
    best = [tuple(r) for r in top_pairs(lines, k=3).collect()]
    assert best == sorted(pairs.items(), key=lambda r: (-r[1], r[0]))[:3]


def test_pairs_stay_within_a_line(spark, rows):
    df = spark.createDataFrame([("a b\nc d\n\ne",)], "text string")
    assert rows(pair_rows(line_rows(df, "text"))) == [("a", "b"), ("c", "d")]


def test_whole_text_split_equals_line_split(spark, rows):
    df = spark.createDataFrame([("a b\nc  d\n\ne",)], "text string")
    by_line = rows(word_rows(line_rows(df, "text"), keep_empty=True))
    assert rows(word_rows(df, "text", SPACE_OR_NEWLINE, keep_empty=True)) == by_line
    assert len(rows(word_rows(df, "text", WHITE_RUN))) == 5


def test_saved_counts(lines, spark, tmp_path, rows):
    write_pairs(count_by(word_rows(lines), "word"), "word", "cnt", str(tmp_path / "out"))
    saved = {r[0] for r in rows(read_lines(spark, str(tmp_path / "out")))}
    assert "(Spark,3)" in saved and "(to,2)" in saved


def test_min_partitions(spark, lines, tmp_path):
    assert read_lines(spark, str(tmp_path / "text.txt"), min_partitions=3).rdd.getNumPartitions() == 3


def test_plans_stay_in_the_jvm(lines, plan):
    for df in (top_words(lines), word_listing(lines), digest_counts(lines), top_pairs(lines)):
        text = plan(df)
        assert "Python" not in text and "Arrow" not in text
    assert "TakeOrderedAndProject" in plan(top_words(lines))
    assert plan(top_words(lines)).count("Exchange") == 1


def test_top_k_of_numbers(spark):
    df = spark.range(100).selectExpr("id", "id % 10 as v")
    assert [r["id"] for r in top_k(df, 3, "v", ["id"]).collect()] == [9, 19, 29]
