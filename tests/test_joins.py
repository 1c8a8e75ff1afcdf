"""Joins against brute force, with the splitting of hot keys forced on small data."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.operators.joins import equi_join, range_join, with_attributes

LEFT, RIGHT = "k int, a int", "k int, b int"


def brute(left, right, how):
    out = Counter()
    if how in ("semi", "anti"):
        keys = {k for k, _ in right if k is not None}
        return Counter(r for r in left if (r[0] in keys) == (how == "semi"))
    for k, a in left:
        hits = [b for kk, b in right if k is not None and k == kk]
        out.update((k, a, b) for b in hits)
        if not hits and how == "left":
            out[(k, a, None)] += 1
    if how == "right":
        keys = {k for k, _ in left if k is not None}
        out.update((k, None, b) for k, b in right if k not in keys)
    return out


@pytest.mark.parametrize("how", ["inner", "left", "right", "semi", "anti"])
@pytest.mark.parametrize("split", [None, "left", "right"])
def test_joins_on_skewed_keys(spark, how, split):
    rng = random.Random(f"{how}{split}")
    # A third of the rows of both sides have key 1; key 5 is hot on the left, 6 on the right.
    left = [(1, i) for i in range(40)] + [(5, i) for i in range(25)] + [(rng.choice([2, 3, 7, None]), i) for i in range(40)]
    right = [(1, i) for i in range(30)] + [(6, i) for i in range(25)] + [(rng.choice([2, 4, 8, None]), i) for i in range(40)]
    got = equi_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", how, split, 3 if split else 1
    )
    assert Counter(tuple(r) for r in got.collect()) == brute(left, right, how)


key = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(key, st.integers(0, 2)), max_size=14),
    right=st.lists(st.tuples(key, st.integers(0, 2)), max_size=14),
    how=st.sampled_from(["inner", "left", "right", "semi", "anti"]),
    split=st.sampled_from(["left", "right"]),
)
def test_any_input(spark, left, right, how, split):
    got = equi_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", how, split, 2
    )
    assert Counter(tuple(r) for r in got.collect()) == brute(left, right, how)


@pytest.mark.parametrize("copies", [False, True])
def test_a_hot_key_is_spread(spark, copies):
    number = F.lit(5) if copies else F.col("id")
    facts = spark.range(0, 3000, 1, 20).select(F.lit(1).alias("k"), number.alias("a"))
    people = spark.createDataFrame([(1, 10), (2, 20)], RIGHT)
    joined = equi_join(people, facts, "k", "left", split="right", salts=30)
    # Partitions as the shuffle makes them, without adaptive merging.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 3001
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 2000


def test_a_compressed_hot_key_is_spread_too(spark, tmp_path):
    """A table of one key takes a few kilobytes on disk; no plan depends on that."""
    spark.range(0, 400_000, 1, 4).select(F.lit(1).alias("k"), F.lit(7).alias("a")).write.parquet(str(tmp_path / "hot"))
    facts = spark.read.parquet(str(tmp_path / "hot"))
    people = spark.createDataFrame([(1, 10), (2, 20)], RIGHT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        joined = equi_join(people, facts, "k", "left", split="right", salts=64)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 400_001 and sizes[-1] <= 200_000


@pytest.mark.parametrize("how, split", [("left", "right"), ("right", "left"), ("inner", "left"), ("left", "left")])
def test_copies_for_salts_are_not_broadcast(spark, plan, how, split):
    """Spark expects the copied side to be as small as before it was copied."""
    facts = spark.range(1000).selectExpr("id % 50 as k", "id as a")
    people = spark.range(50).selectExpr("id as k", "id as b")
    assert "BroadcastHashJoin [k" in plan(equi_join(facts, people, "k"))
    sides = (facts, people) if split == "left" else (people, facts)
    joined = equi_join(*sides, "k", how, split, 8)
    assert joined.count() == 1000
    text = plan(joined)
    assert "SortMergeJoin [k" in text and not [x for x in text.split("\n") if "BroadcastHashJoin" in x and "_salt" in x]


def test_salts_need_a_side(spark):
    df = spark.range(3).selectExpr("id as k")
    with pytest.raises(ValueError):
        equi_join(df, df, "k", salts=2)
    with pytest.raises(ValueError):
        equi_join(df, df, "k", split="both")


def test_text_against_number_is_refused(spark):
    numbers, words = spark.range(3).selectExpr("id as k"), spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError):
        equi_join(numbers, words, "k")
    with pytest.raises(TypeError):
        with_attributes(numbers, words.withColumnRenamed("k", "id"), "k", "id")


def test_a_broadcast_is_the_callers_or_sparks_choice(spark, plan):
    facts = spark.range(1000).selectExpr("id as a")
    dims = spark.range(1000).selectExpr("id as b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(with_attributes(facts, dims, "a", "b"))
        assert "BroadcastHashJoin" in plan(with_attributes(facts, dims, "a", "b", broadcast=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("salts", [1, 2, 7])
def test_range_join_against_brute_force(spark, salts):
    rng = random.Random(3)
    zero = dt.datetime(2024, 1, 1)
    # Key 1 holds most rows; times fall on slot edges and range ends as well.
    points = [(rng.choice([1, 1, 1, 2]), i, zero + dt.timedelta(seconds=rng.choice([0, 3600, 7200, rng.randrange(20000)]))) for i in range(120)]
    starts = [(rng.choice([1, 1, 2, 3]), i, zero + dt.timedelta(seconds=rng.choice([0, 3600, rng.randrange(20000)]))) for i in range(80)]
    p = spark.createDataFrame(points, "k int, p int, pt timestamp")
    s = spark.createDataFrame(starts, "sk int, s int, st timestamp")
    joined = range_join(
        p,
        s,
        "k",
        "sk",
        "pt",
        "st",
        3600,
        salts,
    )
    assert joined.columns == ["k", "p", "pt", "sk", "s", "st"]
    got = Counter((r["p"], r["s"]) for r in joined.collect())
    hour = dt.timedelta(hours=1)
    want = Counter((a, b) for k, a, t in points for kk, b, u in starts if k == kk and u <= t <= u + hour)
    assert got == want and max(got.values()) == 1


def test_range_join_with_fractions_of_a_second(spark):
    p = spark.sql("select 1 k, timestamp'2024-01-01 01:00:00.5' pt union all select 1, timestamp'2024-01-01 01:00:00.500001'")
    s = spark.sql("select 1 sk, timestamp'2024-01-01 00:00:00.5' st")
    assert range_join(p, s, "k", "sk", "pt", "st", 3600).count() == 1
