import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tallybrook.llm import near_dups
from tallybrook.llm.near_dups import (
    block_pairs,
    components,
    likely_similar,
    near_duplicates,
    one_per_group,
    set_sketches,
    shingle_hashes,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text, size):
    words = (text or "").translate(LOWER).encode().split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def groups(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if similar(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies of any distance, chains, shared passages, short and empty texts."""
    r = random.Random(11)
    words = [f"w{k}" for k in range(400)]

    def text(n):
        return [r.choice(words) for _ in range(n)]

    out = [" ".join(text(n)) for n in (5, 40, 80, 300, 1_500)]
    base = text(120)
    for edits in range(14):
        for _ in range(5):
            own = list(base)
            for k in r.sample(range(120), edits):
                own[k] = r.choice(words)
            out.append(" ".join(own))
    chain = text(150)
    for k in range(12):
        chain = chain[6:] + text(6)
        out.append(" ".join(chain))
    passage = text(60)
    out += [" ".join(text(40) + passage + text(40)) for _ in range(20)]
    out += ["one two", "ONE  two", "one two three", "", None, " \n", "one", "x" * 9_000]
    out += [out[3].upper() + "\n", out[3], out[3]]
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_components_as_by_brute_force(spark, corpus, size):
    rows = [(i, t, i, "a", None) for i, t in enumerate(corpus)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, registers string, root int")
    sets = {i: brute_set(t, size) for i, t in enumerate(corpus)}
    expected = groups(sets)
    got = {r.doc_id: r for r in near_duplicates(docs.repartition(5), size).collect()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == expected[i]) for i, r in got.items())
    kept = one_per_group(docs, size)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in expected.items() if i == c)


def test_rows_without_ids_repeated_rows_and_no_rows(documents, prose):
    docs = documents([prose(1, 50), prose(2, 50), prose(1, 50), ""])
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert [r[1:] for r in got if r[0] is None] == [(1, None, True)] * 2
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == [(0, 0, True)] * 3 + [(1, 1, True), (2, 0, False), (3, 3, True)]
    kept = one_per_group(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["0", "1", "3", "None"]
    assert near_duplicates(docs.limit(0)).collect() == [] and one_per_group(docs.limit(0)).collect() == []


def test_shingles_are_counted_once_and_in_order(corpus):
    hashes, counts = shingle_hashes(pa.array(corpus, pa.string()), 4)
    assert counts.tolist() == [len(brute_set(t, 4)) for t in corpus]
    ends = np.cumsum(counts)
    for e, n in zip(ends, counts, strict=True):
        assert (np.diff(hashes[e - n : e].astype(object)) > 0).all() if n > 1 else True


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(5)
    pool = r.integers(0, 2**63, 40_000).astype(np.uint64)
    for n, share in ((50, 0.9), (400, 0.8), (400, 0.3), (9_000, 0.85)):
        common = int(2 * n * share / (1 + share))
        a, b = pool[:n], np.concatenate([pool[:common], pool[20_000 : 20_000 + n - common]])
        both = set_sketches(np.concatenate([a, b]), np.array([n, n]))
        union = set_sketches(np.union1d(a, b), np.array([len(np.union1d(a, b))]))
        assert (np.maximum(both[0], both[1]) == union[0]).all()
        passed = likely_similar(both[:1], both[1:], np.array([n]), np.array([n]))
        assert passed[0] == (share >= 0.8)
    assert set_sketches(np.zeros(0, np.uint64), np.array([0, 0])).sum() == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(1_000, k) for k in range(1_001, 1_200)] + [(5_000, 5_000), (7, 3)]
    edges += [(r.randint(2_000, 2_200), r.randint(2_000, 2_200)) for _ in range(150)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    expected = {}
    for start in sorted(near):
        stack = [] if start in expected else [start]
        while stack:
            x = stack.pop()
            if x not in expected:
                expected[x] = start
                stack += near[x]
    expected.pop(5_000)
    alone = {a for a, b in edges if a == b and near[a] == {a}}
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {k: v for k, v in expected.items() if k not in alone}
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []


def test_pairs_of_a_large_hub_are_dealt_to_many_tasks_and_complete(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 64)
    n, core = 2_000, 150
    rows = [(1, k, k < n, k, 9, b"r", f"t{k}") for k in range(n + core)] + [(2, 5_000, False, 1, 9, b"r", "a"), (2, 5_001, True, 2, 9, b"r", "b")]
    schema = "hub long, node long, rest boolean, root long, n long, registers binary, text string"
    pairs = block_pairs(spark.createDataFrame(rows, schema))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        met = pairs.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    seen = set()
    for x in met:
        for a in x.left:
            for b in x.right:
                if a.node != b.node:
                    pair = (x.hub, *sorted((a.node, b.node)))
                    assert x.same or pair not in seen
                    seen.add(pair)
    hub = {(1, a, b) for a in range(n) for b in range(a + 1, n + core)}
    assert seen == hub | {(2, 5_000, 5_001)}
    tasks = Counter(x.task for x in met if x.hub == 1)
    assert len(tasks) >= 10 and max(tasks.values()) < 0.5 * sum(tasks.values())
