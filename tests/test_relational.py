"""Grouping, cleaning, shaping, profiles and row functions on small known tables."""

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.values import mask_number, mask_salted, number_label
from tallybrook.operators import cleaning, counting, grouping, mapping, ordering, shaping
from tallybrook.operators.profile import QUARTER_NAMES, QUARTERS, merged_profile, profile, profile_sketches
from tallybrook.plans import lottery
from tallybrook.plans.lottery import multiplier_distribution
from tallybrook.plans.staff import masked_records, pay_by_group


@pytest.fixture
def crew(spark):
    data = [(70, "Ines", 3, "north"), (71, "Okko", 8, "south"), (72, "Tilde", 5, "north"), (73, "Ruben", 8, None)]
    schema = T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("name", T.StringType()),
            T.StructField("berth", T.IntegerType(), False),
            T.StructField("side", T.StringType()),
        ]
    )
    return spark.createDataFrame(data, schema)


def test_pay_by_group(spark, crew):
    pay = spark.createDataFrame([(70, 120), (71, 75), (72, 81), (99, 500), (73, 10)], "id int, pay int")
    totals = [tuple(r) for r in pay_by_group(pay, crew, "id", "side", "pay").collect()]
    assert totals == [("north", 201, 100.5), ("south", 75, 75.0), (None, 10, 10.0)]


def test_pay_sorts_ties_by_group(spark):
    people = spark.createDataFrame([(1, "b"), (2, "a")], "id int, g string")
    pay = spark.createDataFrame([(1, 5), (2, 5)], "id int, v int")
    assert [r["g"] for r in pay_by_group(pay, people, "id", "g", "v").collect()] == ["a", "b"]


def test_sums_through_a_join_equal_sums_after_it(spark, rows):
    rng = random.Random(1)
    facts = [(1, rng.choice([1.25, 2.5, None])) for _ in range(60)] + [(rng.choice([2, 3, None]), 0.75) for _ in range(60)]
    people = [(1, "a"), (1, "b"), (2, "a"), (4, "c")]
    f = spark.createDataFrame(facts, "k int, v double")
    p = spark.createDataFrame(people, "k int, g string")
    for exact in (None, "decimal(18,2)"):
        early = grouping.sum_avg_through_join(f, p, "k", ["g"], "v", "s", "a", exact)
        late = grouping.sum_avg_by(f.join(p, "k"), ["g"], "v", "s", "a", exact)
        assert rows(early) == rows(late)


def test_sums_keep_small_fractions(spark, rows):
    df = spark.createDataFrame([("a", 0.001), ("a", 0.002)], "g string, v double")
    assert rows(grouping.sum_avg_by(df, ["g"], "v", "s", "a")) == [("a", 0.003, 0.0015)]


def test_average_of_nothing_is_null(spark, rows):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert rows(grouping.sum_avg_by(df, ["g"], "v", "s", "a")) == [("a", None, None)]


def test_average_of_text(spark, rows):
    df = spark.createDataFrame([("a", "1.5"), ("a", "2.5"), ("a", "bad"), ("b", "worse")], "g string, v string")
    assert rows(grouping.average_of_text(df, ["g"], "v", "avg")) == [("a", 2.0), ("b", None)]


def write_draws(spark, folder, draws):
    data = [(number, batch) for batch, numbers in draws.items() for number in numbers]
    spark.createDataFrame(data, "carNum string, batchNum int").write.partitionBy("batchNum").parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("broadcast", [True, False])
def test_multipliers(spark, tmp_path, broadcast, plan):
    entries = write_draws(
        spark,
        str(tmp_path / "apply"),
        {201512: ["c1"], 201601: ["c1", "c1", "c2"], 201706: ["c1", "c1", "c1", "c2", "c3"]},
    )
    winners = write_draws(spark, str(tmp_path / "lucky"), {201512: ["c3"], 201601: ["c2"], 201706: ["c1"]})
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = multiplier_distribution(entries, winners, "carNum", "batchNum", "201601")
        assert [tuple(r) for r in result.collect()] == [(1, 1), (3, 1)]
        text = plan(result)
        assert ("BroadcastHashJoin" in text) == broadcast
        assert "PartitionFilters: [isnotnull(batchNum" in text and ">= 201601)" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_multipliers_with_repeated_wins(spark, limit):
    """Against the join as it reads: copies of the joined rows per batch and number."""
    rng = random.Random(5)
    entries = [(f"c{rng.choice([1, 1, 1, 2, 3, 4])}", rng.choice([1, 2, 3])) for _ in range(80)]
    winners = [(f"c{rng.choice([1, 2, 5])}", rng.choice([0, 2, 3])) for _ in range(12)]
    copies = Counter((b, n) for n, b in entries for w, since in winners if w == n and since >= 2)
    best = {}
    for (_, n), c in copies.items():
        best[n] = max(best.get(n, 0), c)
    e, w = spark.createDataFrame(entries, "n string, b int"), spark.createDataFrame(winners, "n string, b int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = [tuple(r) for r in multiplier_distribution(e, w, "n", "b", 2).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(Counter(best.values()).items())


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_many_entries_are_counted_in_more_parts(spark, plan, monkeypatch, limit):
    """The parts follow the number of entries, so what one task counts does not grow with the table."""
    monkeypatch.setattr(lottery, "ENTRIES_PER_TASK", 100)
    e = spark.range(1000).selectExpr("id % 50 as n", "id % 4 as b")
    w = spark.range(60).selectExpr("id as n", "2 as b")
    best = {}
    for (_, n), c in Counter((i % 4, i % 50) for i in range(1000)).items():
        best[n] = max(best.get(n, 0), c)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = multiplier_distribution(e, w, "n", "b", 2)
        assert "10), REPARTITION_BY_NUM" in plan(found)
        assert [tuple(r) for r in found.collect()] == sorted(Counter(best.values()).items())
        monkeypatch.setattr(lottery, "ENTRIES_PER_TASK", 1000)
        assert "REPARTITION_BY_NUM" not in plan(multiplier_distribution(e, w, "n", "b", 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def murmur3(number, seed=42):
    """Murmur3 of one 32-bit integer, as a signed number."""
    full = 0xFFFFFFFF
    turn = lambda x, n: (x << n | x >> (32 - n)) & full
    h = seed ^ (turn(number * 0xCC9E2D51 & full, 15) * 0x1B873593 & full)
    h = (turn(h, 13) * 5 + 0xE6546B64 & full) ^ 4
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & full
    return h - (1 << 32) if h >> 31 else h


def test_masked_records(crew, rows):
    records = masked_records(crew, "id", "name", "berth", {"side": "place"})
    assert records.columns == ["id", "name", "place", "id_name", "crypto"]
    assert [(r["id_name"], r["crypto"]) for r in records.orderBy("id").collect()] == [
        (f"{i}_{name}", murmur3(berth)) for i, name, berth in ((70, "Ines", 3), (71, "Okko", 8), (72, "Tilde", 5), (73, "Ruben", 8))
    ]
    salted = masked_records(crew, "id", "name", "berth", salt="s")
    assert all(len(r["crypto"]) == 64 for r in salted.collect())


def test_masks(spark):
    row = spark.range(1).select(mask_number(F.lit(26)).alias("a"), mask_salted(F.lit(26), "x").alias("b")).first()
    import hashlib

    assert row["a"] == -1223696181 and row["b"] == hashlib.sha256(b"x26").hexdigest()


def test_declared_schema_is_kept(crew):
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in crew.schema.fields] == [
        ("id", "int", False),
        ("name", "string", True),
        ("berth", "int", False),
        ("side", "string", True),
    ]


def test_one_per_key(crew, rows):
    assert {r["side"] for r in cleaning.one_per_key(crew, ["side"]).collect()} == {"north", "south", None}
    kept = cleaning.one_per_key(crew, ["side"], ["berth"])
    assert kept.columns == crew.columns
    assert {r[0] for r in rows(kept)} == {70, 71, 73}


def test_null_handling(spark, rows):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert rows(cleaning.fill_nulls(df, {"a": 0, "b": "-"})) == [(0, "x"), (1, "-"), (2, "y")]
    assert rows(cleaning.drop_nulls(df)) == [(2, "y")]
    assert rows(cleaning.drop_nulls(df, ["a"])) == [(1, None), (2, "y")]
    assert rows(cleaning.replace_values(df, {"y": "z"}, ["b"])) == [(None, "x"), (1, None), (2, "z")]


def test_distinct_and_union(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, s string")
    assert len(rows(cleaning.distinct_rows(df))) == 2
    assert len(rows(shaping.stack_rows(df, df.select("s", "i"), df))) == 9


def test_conform(spark, rows):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("d", T.DateType())])
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", None), (None, "no day"), ("3", None)], "n string, d string")
    table = cleaning.conform(df, schema)
    assert len(rows(cleaning.accepted(table))) == 2
    assert cleaning.accepted(table).columns == ["n", "d"]
    assert {tuple(r["_rejects"]) for r in cleaning.rejected(table).collect()} == {
        ("n: bad value",),
        ("n: missing", "d: bad value"),
    }
    with pytest.raises(ValueError, match="columns not found: d"):
        cleaning.conform(df.drop("d"), schema)


def test_text_to_items(spark, rows):
    raw = spark.createDataFrame([("4", "rope;sail"), ("5", "rope"), ("6", "oar;sail;map")], "a string, b string")
    named = shaping.name_columns(raw, ["id", "gear"], {"gear": ";"})
    assert rows(shaping.unfold(named, "gear", "item")) == [("4", "rope"), ("4", "sail"), ("5", "rope"), ("6", "map"), ("6", "oar"), ("6", "sail")]
    empty = spark.createDataFrame([(1, []), (2, None)], "id int, items array<string>")
    assert rows(shaping.unfold(empty, "items", "item")) == []


def test_values_per_key(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    assert rows(counting.values_per_key(df, ["k"], "v")) == [(1, 0, ["a", "b"]), (2, 0, []), (3, 0, ["c"])]
    many = spark.range(100).selectExpr("nullif(id % 2, 1) as k", "id as v").union(spark.sql("select 7L, 1L union all select 7L, null"))
    parted = counting.values_per_key(many, ["k"], "v", values=13).collect()
    assert Counter(r["k"] for r in parted) == {0: 4, None: 4, 7: 1}
    assert sorted(v for r in parted if r["k"] != 7 for v in r["vals"]) == list(range(100))
    assert all(r["vals"] == sorted(r["vals"]) for r in parted) and [r["vals"] for r in parted if r["k"] == 7] == [[1]]


def test_reduce_by_key(spark, rows):
    df = spark.range(5000).selectExpr("id % 7 as k", "id as v").repartition(8)
    want = [(k, max(v for v in range(5000) if v % 7 == k)) for k in range(7)]
    assert rows(counting.reduce_by_key(df, ["k"], "v", lambda s: s.max())) == want
    # A tiny limit of held keys makes tasks give their partial results out early.
    assert rows(counting.reduce_by_key(df, ["k"], "v", lambda s: s.max(), held_keys=2)) == want
    assert rows(counting.reduce_by_key(df, [], "v", lambda s: s.sum())) == [(sum(range(5000)),)]


def test_reduce_merges_a_value_once_per_step(spark, rows, tmp_path):
    """Keys that are held are not merged again with each batch: the calls do not grow with the square of a task's batches."""

    def merge(values):
        with open(tmp_path / "calls", "ab") as calls:
            calls.write(b".")
        return values.max()

    df = spark.range(0, 40_000, 1, 1).selectExpr("id % 2000 as k", "id as v")
    assert rows(counting.reduce_by_key(df, ["k"], "v", merge)) == sorted(((k, 38_000 + k) for k in range(2000)), key=lambda r: str(r[0]))
    assert (tmp_path / "calls").stat().st_size < 4500


@pytest.mark.parametrize("held", [1, 100_000])
def test_reduce_with_any_function_of_values(spark, rows, held):
    """Lone values go through the function too; a function may give null; texts and decimals keep their type."""
    df = spark.createDataFrame([(1, -5.0), (2, -1.0), (2, 3.0), (3, None), (None, -2.0)], "k int, v double").repartition(3)
    assert rows(counting.reduce_by_key(df, ["k"], "v", lambda s: s.abs().max(), held)) == [(None, 2.0), (1, 5.0), (2, 3.0), (3, None)]
    assert {r[1] for r in rows(counting.reduce_by_key(df, ["k"], "v", lambda s: None, held))} == {None}
    words = df.selectExpr("k", "cast(v as string) as v")
    assert rows(counting.reduce_by_key(words, ["k"], "v", lambda s: s.min(), held)) == [(None, "-2.0"), (1, "-5.0"), (2, "-1.0"), (3, None)]
    money = df.selectExpr("k", "cast(v as decimal(18,2)) as v")
    assert [str(r[1]) for r in rows(counting.reduce_by_key(money, ["k"], "v", lambda s: s.sum(), held))] == ["-2.00", "-5.00", "2.00", "None"]


def test_reduce_keeps_large_numbers_and_null_keys(spark, rows):
    large = 2**60 + 1
    df = spark.createDataFrame([(large, 1), (None, large), (large, 2), (None, 3), (4, None)], "k bigint, v bigint")
    assert rows(counting.reduce_by_key(df, ["k"], "v", lambda s: s.max())) == [(None, large), (large, 2), (4, None)]


def test_sampling(spark, rows):
    df = spark.range(4000)
    part = shaping.sample_by_key(df, "id", 0.25)
    assert rows(part) == rows(shaping.sample_by_key(df.repartition(7), "id", 0.25))
    assert 850 < part.count() < 1150
    assert shaping.sample_by_key(df, "id", 0).count() == 0 and shaping.sample_by_key(df, "id", 1).count() == 4000
    assert 850 < shaping.sample_rows(df, 0.25, 1).count() < 1150
    with pytest.raises(ValueError):
        shaping.sample_by_key(df, "id", 2)


def test_sorting(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (2, "b")], "n int, s string")
    assert [tuple(r) for r in ordering.sort_by(df, F.desc("n"), F.asc("s")).collect()] == [(2, "a"), (2, "b"), (1, "b")]
    assert [tuple(r) for r in ordering.first_rows(df, 2, ["s", "n"]).collect()] == [(2, "a"), (1, "b")]
    assert [tuple(r) for r in grouping.distribution(df, "n").collect()] == [(1, 1), (2, 2)]


def test_partitions(spark):
    df = spark.range(100)
    assert shaping.repartition(df, 6).rdd.getNumPartitions() == 6
    assert shaping.coalesce(shaping.repartition(df, 6), 2).rdd.getNumPartitions() == 2
    assert shaping.balanced(df, "id").count() == 100


@pytest.mark.parametrize("exact", [None, ["i", "s", "x", "l"], ["s"]])
def test_profile(spark, exact):
    df = spark.createDataFrame(
        [(1, "a", 0.0, [1]), (2, None, -0.0, [1]), (None, "a", 2.0, [2])], "i int, s string, x double, l array<int>"
    )
    table = {r["column_name"]: r for r in profile(df, exact).collect()}
    assert [tuple(table["i"])[3:8] for _ in (0,)] == [(3, 1, 2, "1", "2")]
    assert (table["i"]["mean"], table["s"]["mean"]) == (1.5, None)
    assert (table["s"]["null_count"], table["s"]["distinct_count"], table["s"]["data_type"]) == (1, 1, "string")
    assert table["x"]["distinct_count"] == 2 and table["l"]["distinct_count"] == 2


def numbers(spark, n):
    """Skewed numbers, some missing, and the sorted ones that are there."""
    r = random.Random(n)
    values = [None if r.random() < 0.1 else round(r.lognormvariate(3, 2), 3) for _ in range(n)]
    frame = spark.createDataFrame([(i, v, None if v is None else f"t{int(v) % 900}") for i, v in enumerate(values)], "i long, x double, s string")
    return frame.repartition(5), sorted(v for v in values if v is not None)


def rank_off(ordered, value, share):
    """How far a value's ranks are from a share of all, as a share of all."""
    import bisect

    low, high, at = bisect.bisect_left(ordered, value), bisect.bisect_right(ordered, value), share * len(ordered)
    return max(0, low - at, at - high) / len(ordered)


def test_quartiles_keep_their_rank_error(spark):
    frame, ordered = numbers(spark, 30_000)
    for error in (1e-4, 0.01):
        row = {r["column_name"]: r for r in profile(frame, rank_error=error).collect()}
        for name, share in zip(QUARTER_NAMES, QUARTERS, strict=True):
            assert rank_off(ordered, row["x"][name], share) <= error + 1 / len(ordered)
            assert row["s"][name] is None


def test_a_profile_merged_from_batches_is_that_of_all_rows(spark, tmp_path, plan):
    frame, ordered = numbers(spark, 20_000)
    whole = merged_profile(profile_sketches(frame)).collect()
    parts = [frame.where("i < 1000"), frame.where("i between 1000 and 14999"), frame.where("i >= 15000"), frame.limit(0)]
    for k, part in enumerate(parts):
        profile_sketches(part).write.parquet(str(tmp_path / f"b={k}"))
    stored = spark.read.parquet(str(tmp_path))
    assert stored.count() == 12
    merged = merged_profile(stored)
    exact = {r["column_name"]: r for r in profile(frame, ["i", "x", "s"]).collect()}
    for a, b in zip(whole, merged.collect(), strict=True):
        c = exact[a["column_name"]]
        for field in ("data_type", "nullable", "row_count", "null_count", "min_value", "max_value"):
            assert a[field] == b[field] == c[field]
        assert a["distinct_count"] == b["distinct_count"] and abs(b["distinct_count"] / c["distinct_count"] - 1) < 0.05
        for field in ("mean", "stddev"):
            assert b[field] is c[field] is None or b[field] == pytest.approx(c[field], rel=1e-9)
    x = merged.where("column_name = 'x'").first()
    assert all(rank_off(ordered, x[q], p) < 0.002 for q, p in zip(QUARTER_NAMES, QUARTERS, strict=True))


def test_no_rows_and_lone_kinds_have_a_merged_profile(spark):
    frame = spark.sql("select 1 a, map('k', 1) m, array(2) l, cast(null as double) n, 12345678901234567890123.45BD d, X'01' b, 'NaN'::double x")
    got = {r["column_name"]: r for r in merged_profile(profile_sketches(frame)).collect()}
    assert got["m"]["min_value"] is None and got["n"]["null_count"] == 1 and got["a"]["stddev"] is None
    assert merged_profile(profile_sketches(frame.limit(0))).where("row_count = 0 and distinct_count = 0").count() == 7


def test_verdicts_are_written_and_counted_in_one_pass(spark, tmp_path, rows):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False)])
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    loaded = spark.createDataFrame([("1",), ("x",), (None,), ("4",), ("5",)], "n string").mapInArrow(seen, "n string")
    counts = cleaning.write_by_verdict(cleaning.conform(loaded, schema), str(tmp_path / "t"))
    assert counts == {"accepted": 3, "rejected": 2} and reads.value == 5
    written = spark.read.parquet(str(tmp_path / "t"))
    assert rows(written.where("verdict = 'accepted'").select("n", "_raw")) == [(1, None), (4, None), (5, None)]
    assert rows(written.where("verdict = 'rejected'").select("_raw.n")) == [(None,), ("x",)]


def test_profile_of_no_rows(spark):
    df = spark.createDataFrame([], "i int, s string")
    assert [(r["row_count"], r["distinct_count"]) for r in profile(df).collect()] == [(0, 0), (0, 0)]


def test_range_labels(spark):
    assert [r[0] for r in spark.range(1, 5).select(number_label(F.col("id"))).collect()] == ["No: 1", "No: 2", "No: 3", "No: 4"]


def test_row_functions(spark, rows, plan):
    numbers = spark.range(1, 5)
    label = mapping.vector_function(lambda s: "No: " + s.astype(str), "string")
    labelled = numbers.select(label("id").alias("label"))
    assert rows(labelled) == [("No: 1",), ("No: 2",), ("No: 3",), ("No: 4",)]
    assert "ArrowEvalPython" in plan(labelled)
    doubled = mapping.map_frames(numbers, lambda pdf: pd.DataFrame({"number": pdf["id"] * 2}), "number bigint")
    assert rows(doubled) == [(2,), (4,), (6,), (8,)]
    assert rows(mapping.as_record(numbers, "id")) == [(1,), (2,), (3,), (4,)]


def test_setup_runs_once_per_task(spark, tmp_path, rows):
    def setup():
        import uuid

        (tmp_path / uuid.uuid4().hex).touch()
        return 10

    added = mapping.map_with_setup(
        spark.range(0, 40_000, 1, 2), setup, lambda ten, pdf: pd.DataFrame({"n": pdf["id"] + ten}), "n bigint"
    )
    assert added.agg(F.min("n"), F.max("n")).first() == (10, 40_009)
    assert len(list(tmp_path.iterdir())) == 2


def test_writer_per_task(spark, tmp_path):
    def write(number, batches):
        (tmp_path / f"part-{number}").write_text("\n".join(str(n) for b in batches for n in b.column("id").to_pylist()))

    for _ in range(2):  # a task that runs again replaces its part
        assert mapping.for_each_task(spark.range(0, 10, 1, 3), write) == 10
    parts = sorted(p.name for p in tmp_path.iterdir())
    assert parts == ["part-0", "part-1", "part-2"]
    assert sum(len(p.read_text().split()) for p in tmp_path.iterdir()) == 10


def test_keys_without_values_stay(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (1, 2.0), (2, None), (3, None), (3, 7.0)], "k int, v double")
    assert rows(counting.reduce_by_key(df, ["k"], "v", lambda s: s.max())) == [(1, 5.0), (2, None), (3, 7.0)]
    assert rows(counting.values_per_key(df, ["k"], "v")) == [(1, 0, [2.0, 5.0]), (2, 0, []), (3, 0, [7.0])]
    assert rows(counting.reduce_by_key(df.where("k = 2"), [], "v", lambda s: s.max())) == [(None,)]
    assert rows(counting.reduce_by_key(df.limit(0), [], "v", lambda s: s.max())) == []
