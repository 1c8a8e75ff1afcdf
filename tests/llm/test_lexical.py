import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import lexical
from tallybrook.llm.lexical import BallTree, Best, impacts, ranked_documents, terms_of

ITEMS = "item_id long, text string, doc_id string, score int, `rank` int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) of each different item, by scoring every document."""
    counted = [(i, plain_terms(t)) for i, t in docs]
    counted = [(i, t) for i, t in counted if t]
    n_docs, n_terms = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, t in counted:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, t in counted:
            m = 100 - 75 + 75 * len(t) * n_docs // n_terms
            s = sum(weight[w] * (10**9 * t.count(w) // (1000 * t.count(w) + 8 * m)) for w in plain_terms(text) if w in t)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("tree_docs, leaf, item_bytes, k", [(4096, 32, 4 << 20, 10), (40, 3, 200, 4), (16, 1, 1, 1)])
def test_ranks_as_by_brute_force(spark, documents, prose, texts, monkeypatch, tree_docs, leaf, item_bytes, k):
    monkeypatch.setattr(lexical, "TREE_DOCS", tree_docs)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    bodies = [*texts, *(prose(s, 20 + s % 30) for s in range(10, 150)), *(prose(7, 40),) * 5, "Σας σας 123 a1-b2 A1", "a1 " * 50]
    frame = documents(bodies)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    asked = [(i, prose(20 + i, 12) + " " + prose(7, 5)) for i in range(9)]
    asked += [(20, "A1, b2! σας \x1c nowhere"), (21, None), (22, ""), (23, "not found at all"), (24, "a1 a1 a1 b2"), (20, "a1")]
    asked += [(None, prose(30, 6)), asked[0], (25, prose(4, 9_000))]
    items = spark.createDataFrame([(*x, "d", 1, 2) for x in asked], ITEMS)
    got = ranked_documents(frame.repartition(3), items, k=k, item_bytes=item_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(map(tuple, got.collect())) == ordered(brute(rows, asked, k))


def test_nothing_to_rank(spark, documents):
    items = spark.createDataFrame([(1, "one", "", 1, 2)], ITEMS)
    frame = documents(["one text", "two"])
    assert ranked_documents(frame, items.limit(0)).collect() == []
    assert ranked_documents(frame.limit(0), items).collect() == []
    assert ranked_documents(documents([None, "", "-"]).where("doc_id IS NOT NULL"), items).collect() == []


def test_terms_are_cut_at_ascii_signs_only():
    text = ["A-b_c\x00d`e{f~g", None, "Ünï  x y", "", "  42nd\n"]
    flat, n = terms_of(pa.array(["skipped", *text])[1:])
    assert n.tolist() == [7, 0, 2, 0, 1]
    assert flat.to_pylist() == [w for t in text for w in plain_terms(t)]


def grown(r, docs, leaf, monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    bags = [{r.randrange(60) * 7: r.randrange(1, 5) for _ in range(r.randrange(1, 12))} for _ in range(docs)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    terms = np.array([t for b in bags for t in sorted(b)], np.int64)
    tf = np.array([b[t] for b in bags for t in sorted(b)], np.int64)
    values = impacts(tf, np.repeat(np.array([sum(b.values()) for b in bags]), np.diff(starts)), docs, int(tf.sum()))
    vectors = [dict(zip(terms[a:b].tolist(), values[a:b].tolist(), strict=True)) for a, b in zip(starts, starts[1:], strict=False)]
    ids = np.arange(docs) * 3
    return BallTree(ids, np.zeros(docs, bool), starts, terms, values), dict(zip(ids.tolist(), vectors, strict=True))


@pytest.mark.parametrize("seed", range(4))
def test_no_document_scores_above_the_bound_of_a_node_over_it(monkeypatch, seed):
    r = random.Random(seed)
    tree, vectors = grown(r, 150, 1 + seed * 3, monkeypatch)
    for _ in range(20):
        names = np.array(sorted(r.sample(range(0, 420, 7), 8)), np.int64)
        weights = np.array([r.randrange(1, 30_000) for _ in names], np.int64)
        known = np.isin(names, tree.names)
        bounds = tree.bounds(np.searchsorted(tree.names, names[known]), weights[known])
        query = dict(zip(names.tolist(), weights.tolist(), strict=True))
        for node, (low, high) in enumerate(zip(tree.low, tree.high, strict=True)):
            scores = [sum(v * query.get(t, 0) for t, v in vectors[i].items()) for i in tree.ids[low:high].tolist()]
            assert max(scores) <= bounds[node]


def test_subtrees_out_of_reach_are_not_scored(monkeypatch):
    r = random.Random(5)
    tree, vectors = grown(r, 2000, 8, monkeypatch)
    added = []
    monkeypatch.setattr(Best, "add", lambda self, s, *x, add=Best.add: (added.append(len(s)), add(self, s, *x)))
    best = Best(3)
    rare = np.array([7, 14], np.int64)
    tree.search(rare, np.array([9_000, 5_000], np.int64), best)
    want = sorted((-(9_000 * v.get(7, 0) + 5_000 * v.get(14, 0)), i) for i, v in vectors.items())[:3]
    assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == want
    assert sum(tree.leaf) > 200 and len(added) < sum(tree.leaf) / 2
