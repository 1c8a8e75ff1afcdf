import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import topk
from tallybrook.llm.topk import top_k

SCHEMA = "id long, vector array<float>, score int, q string, part long"


def whole(v):
    return v and all(x is not None and math.isfinite(x) and abs(x) * 1024 < 2**63 for x in v)


def brute(rows, k):
    """The ranks of each query row, one list per row, by scoring every other row."""
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and whole(v)]
    out = []
    for n, (q, a) in enumerate(ok):
        if q % 3 == 0:
            scores = [sum(x * y for x, y in zip(a, b, strict=False)) for _, b in ok]
            found = [(-max(-(2**63), min(2**63 - 1, s)), c) for m, ((c, _), s) in enumerate(zip(ok, scores, strict=True)) if m != n]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block, query_bytes, k, parts", [(4096, 64 << 20, 10, 3), (7, 300, 4, 64), (16, 1, 1, 5)])
def test_the_best_as_by_brute_force(spark, monkeypatch, block, query_bytes, k, parts):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    r = random.Random(block)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(20)]
    rows += [(300, None), (303, []), (306, [1.0, None, 2.0]), (309, [math.nan] * 6), (312, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(315, [0.5, 0.25]), (318, [1.0] * 9), (321, [0.0] * 6), (324, [-3.5e3] * 6)]
    # Ids that several rows have, alike and not, asked for and not.
    rows += [rows[0], rows[0], (3, rows[7][1]), (4, rows[3][1]), rows[4]]
    frame = spark.createDataFrame([(*x, 1, "q", 2) for x in rows], SCHEMA).repartition(parts)
    got = top_k(frame, F.col("id") % 3 == 0, k=k, block=block, query_bytes=query_bytes)
    assert sorted(map(tuple, got.collect())) == brute(rows, k)


def test_components_beyond_64_bits_are_left_out_and_scores_stop_there(spark):
    rows = [(0, [1e15, 2.0]), (1, [1e15, 1.0]), (2, [-1e15, 1.0]), (3, [1e30, 1.0]), (4, [0.0, -1.0]), (6, [-1e15, 3.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    frame = spark.createDataFrame([(*x, 1, "q", 2) for x in rows], SCHEMA)
    got = sorted(map(tuple, top_k(frame, F.col("id") % 3 == 0, k=3).collect()))
    assert got == brute(rows, 3)
    assert {r[3] for r in got} >= {2**63 - 1, -(2**63)} and all(r[0] != 3 and r[2] != 3 for r in got)


def test_few_vectors_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0], 1, "", 1), (1, [2.0], 1, "", 1), (1, [2.0], 1, "", 1)], SCHEMA)
    got = top_k(frame, F.col("id") == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 1024 * 2048), (0, 2, 1, 1024 * 2048)]
    assert top_k(frame.limit(0), F.col("id") == 0).collect() == []
    assert top_k(frame, F.col("id") == 9).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 1.0, 3e5]), (1, [1e6 + 0.0625, -1.0, 2e5]), (2, [1e6, 0.001, 2e5])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {r.vec_id: r.score for r in top_k(frame, F.col("id") == 0).collect()}
    scaled = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    assert got == {i: sum(x * y for x, y in zip(scaled[0], scaled[i], strict=True)) for i in (1, 2)}
