import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import mixing
from tallybrook.llm.mixing import mix, mix_plan, source_targets
from tallybrook.llm.sharding import record_size, shards, write_shards


def brute_targets(sizes):
    """Deal out by weight, cut at twice the size, deal out the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values())
    open_ = set(sizes)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - 2 * sizes[s]) for s in open_)
        for s in sizes:
            target[s] = min(target[s], 2.0 * sizes[s])
        open_ = {s for s in open_ if target[s] < 2 * sizes[s]}
    return target


def test_targets_as_by_dealing_out_again_and_again(spark):
    r = random.Random(1)
    for _ in range(6):
        sizes = {s: r.choice([0, 1, 7, 100, 5_000]) * r.randint(1, 9) for s in [None, "Z", "a", "b", "ä", "𝄞", "", "c"][: r.randint(1, 8)]}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {x.source: x.target for x in source_targets(frame).collect()}
        assert got == pytest.approx(brute_targets(sizes), abs=1e-6)
    with pytest.raises(ValueError, match="share"):
        source_targets(frame, share=3)


def test_each_document_is_taken_as_often_as_its_source_needs(documents, texts):
    docs = documents(texts, {5: None, 6: ""})
    rows = mix_plan(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or ""))
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= -int(-rate // 1) <= 2
    again = mix_plan(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    mixed = mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mix(docs.limit(0)).collect() == []


def test_many_sources_are_joined_by_salt(spark, monkeypatch):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") % 7).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
    )
    broad = sorted(map(str, mix_plan(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mix_plan(docs).collect())) == broad


def test_taken_words_come_near_their_target(spark):
    """All sources; the draws of a source's documents may take it off by some standard errors of their sum."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rate = F.col("target") / F.col("source_size")
    part = rate - F.floor(rate)
    plan = mix_plan(docs).where("source_size > 0").groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("n"),
        F.first("target").alias("t"),
        F.sqrt(F.sum(F.col("size") * F.col("size") * part * (1 - part))).alias("error"),
    )
    rows = plan.collect()
    assert len(rows) == docs.select("source").distinct().count()
    assert all(abs(r.n - r.t) <= 4 * r.error + 1e-6 for r in rows)
    total = sum(r.t for r in rows)
    assert abs(sum(r.n for r in rows) - total) <= 4 * sum(r.error**2 for r in rows) ** 0.5 + 1e-6


def test_shards_are_even_and_slots_gapless(documents, texts, tmp_path):
    docs = documents(texts * 9)
    got = shards(docs, shards=7, bucket_bytes=40_000)
    rows = got.collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) == set(range(7)) and {len(s) for s in by.values()} <= {len(rows) // 7, len(rows) // 7 + 1}
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted(map(str, (r.row for r in rows))) == sorted(map(str, docs.collect()))
    write_shards(got, str(tmp_path / "out"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and back.select("shard").distinct().count() == 7
    assert shards(docs.limit(0)).collect() == []


def test_the_order_is_mixed_and_another_seed_mixes_anew(spark):
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    one, two = (
        {r.row.doc_id: (r.shard, r.slot) for r in shards(docs, shards=4, bucket_bytes=4_000, seed=s).collect()} for s in (1, 2)
    )
    assert one != two and len(set(one.values())) == 2_000
    together = sum(one[i][0] == one[i + 1][0] for i in range(1_999))
    assert 350 < together < 650


def test_sizes_count_bytes(spark):
    frame = spark.createDataFrame([("é€",), ("",), (None,)], "t string")
    assert [r[0] for r in frame.select(record_size(F.col("t"))).collect()] == [21, 16, 16]
    assert frame.select(F.crc32(F.coalesce("t", F.lit("")))).first()[0] == zlib.crc32("é€".encode())
