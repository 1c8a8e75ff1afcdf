import hashlib

import pytest
from pyspark.sql import functions as F

from tallybrook.llm.exact_dups import exact_duplicates, retained, take_in

SCHEMA = "doc_id long, text string, digest string, file int, row string, n long, of int, own string, `last` int, `_metadata` string"
CLASHING = ("d", 1, "r", 2, 3, "o", 4, "m")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """(id, id that stays, size, digest) of each row, and how many rows of each text stay."""
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (str(i), str(best[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows
    )


@pytest.fixture
def table(spark, tmp_path):
    def write(rows, parts=2, name="t"):
        path = str(tmp_path / name)
        frame = spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA)
        frame.repartition(parts).write.mode("append").parquet(path)
        return path

    return write


def compared(rows, got):
    """Rows as by brute force, and one row kept per text, one with the id that stays."""
    found = got.withColumn("sha", F.sha2(F.coalesce(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), 256))
    found = found.collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.sha) for r in found) == brute(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.sha for r in found}) == len({r.sha for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def with_texts(spark, path, result):
    docs = spark.read.parquet(path)
    place = docs.metadataColumn("_metadata")
    texts = docs.select("text", place["file_path"].alias("f"), place["row_index"].alias("i"))
    return result.join(texts, (F.col("file") == F.col("f")) & (F.col("row") == F.col("i"))).drop("f", "i")


ROWS = [
    (1, "One text."),
    (2, "one TEXT."),
    (3, "Élan"),
    (4, "élan"),
    (5, "one text. "),
    (6, None),
    (7, ""),
    (8, "x" * 300_000),
    (9, "X" * 300_000),
    (None, "one text."),
    (None, "alone"),
    (None, "alone"),
    (10, "twice"),
    (10, "twice"),
    (-5, "퟿𝄞"),
] + [(100 + i, "a hot text") for i in range(300)]


def test_groups_as_by_brute_force(spark, table):
    path = table(ROWS, 5)
    compared(ROWS, with_texts(spark, path, exact_duplicates(spark, path, max_bytes=1)))


@pytest.mark.parametrize("digest", [lambda t: F.unhex(F.substring(F.md5(t), 1, 1)), lambda t: F.lit(b"all")])
def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark, table, digest):
    rows = ROWS[:15] + [(20 + i, f"text {i % 7}") for i in range(30)]
    path = table(rows, 3)
    compared(rows, with_texts(spark, path, exact_duplicates(spark, path, digest=digest)))


def test_state_is_carried_over_batches_and_starts(spark, table, tmp_path):
    state = str(tmp_path / "state")
    path = table(ROWS, 4)
    take_in(spark, path, state, max_bytes=1)
    before = {bytes(r.digest): r.n for r in retained(spark, state).collect()}
    assert sum(before.values()) == len(ROWS)
    take_in(spark, path, state)
    assert {bytes(r.digest): r.n for r in retained(spark, state).collect()} == before
    more = [(500, "ONE TEXT."), (501, "new"), (0, "alone")]
    table(more, 1)
    compared(ROWS + more, with_texts(spark, path, exact_duplicates(spark, path, state)))
    last = retained(spark, state).where(F.hex("digest") == hashlib.sha256(b"one text.").hexdigest().upper()).first()
    assert (last.doc_id, last.n) == (500, 4)


def test_no_rows(spark, table, tmp_path):
    assert exact_duplicates(spark, table([])).collect() == []
    assert retained(spark, str(tmp_path / "none")).collect() == []


def test_texts_do_not_reach_the_state_and_copies_move_once_per_task(spark, table, tmp_path, plan):
    path, state = table(ROWS, 2), str(tmp_path / "state")
    take_in(spark, path, state)
    held = retained(spark, state)
    assert held.columns == ["digest", "doc_id", "file", "row", "n"]
    got = exact_duplicates(spark, path, state)
    assert "Python" not in plan(got) and "Arrow" not in plan(got)
