import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import spelling
from tallybrook.llm.spelling import LETTERS, block_pairs, close_pairs, letters, one_edit, roots, runs_of, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def edits(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs, least=3):
    counts = {}
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= least and len(w) >= 5}
    forms, out = {}, []
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and edits(x, w)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[w] = best
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.append((w, form, root, n, len(near[w]), counts.get(form)))
    return sorted(out)


def variants(r, word):
    k = r.randrange(len(word))
    return r.choice((word[:k] + word[k + 1 :], word[:k] + r.choice(LETTERS) + word[k:], word[:k] + r.choice(LETTERS) + word[k + 1 :]))


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 4), (3, 1)])
def test_words_and_forms_as_by_brute_force(spark, documents, texts, prose, monkeypatch, seed, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    r = random.Random(seed)
    stems = ["vertandi", "ósculaÿ", "aaaaa", "Rentorum", "ÉLANÉ", "×÷×÷×", "thethe"]
    bodies = list(texts) + [prose(s, 60) for s in range(3)] + ["œuvre Œ naïvé aÃ±o ÿĀÿ " * 3]
    bodies.append(" ".join(["q" * 9_000, "q" * 9_001, "q" * 8_999 + "z"] * 3))
    for _ in range(25):
        words = [r.choice(stems) for _ in range(20)] + [variants(r, r.choice(stems)) for _ in range(12)]
        words += [variants(r, variants(r, "thethe")) for _ in range(4)]
        bodies.append("-".join(words * r.choice((1, 1, 3))))
    frame = documents(bodies)
    rows = [(x.doc_id, x.text) for x in frame.collect()]
    got = spelling_variants(frame.repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(w[1] and w[2] != w[1] for w in want) and any(w[4] > 3 for w in want)


def test_no_words(spark, documents):
    assert spelling_variants(documents([None, "", "a b c", "12345"]).where("doc_id IS NOT NULL")).collect() == []
    assert spelling_variants(documents(["five fives fiver"]).limit(0)).collect() == []


def test_runs_are_maximal():
    text = ["xx", "Ab1cÀÿœé é́-Z", None, "", "×÷ ƒa Ãã\x00b"]
    flat, n = runs_of(pa.array(text)[1:])
    assert flat.to_pylist() == [lower(x) for t in text[1:] for x in RUN.findall(t or "")]
    assert n.tolist() == [len(RUN.findall(t or "")) for t in text[1:]]


def test_the_product_of_letter_counts_keeps_every_edit():
    r = random.Random(9)
    for length in (5, 6):
        a = ["".join(r.choice("abé") for _ in range(5)) for _ in range(80)]
        b = ["".join(r.choice("abé") for _ in range(length)) for _ in range(80)]
        i, j = close_pairs(letters(a), letters(b), False)
        kept = set(zip(i.tolist(), j.tolist(), strict=True))
        assert len(kept) < 80 * 80
        near = one_edit(letters(a)[i], letters(b)[j])
        found = set(zip(i[near].tolist(), j[near].tolist(), strict=True))
        assert found == {(x, y) for x in range(80) for y in range(80) if edits(a[x], b[y])}


def test_blocks_meet_once_and_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)
    r = random.Random(4)
    words = sorted({"".join(r.choice("et") for _ in range(7)) for _ in range(400)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    met = block_pairs(frame).collect()
    assert max(len(x.left) for x in met) <= 32
    seen = set()
    for x in met:
        for a in x.left:
            for b in x.right:
                if not x.same or a.word < b.word:
                    pair = frozenset((a.word, b.word))
                    assert pair not in seen
                    seen.add(pair)
    assert {frozenset((a, b)) for a in words for b in words if a < b and edits(a, b)} <= seen


def test_long_chains_reach_their_end(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    got = {r.word: r.root for r in roots(forms).collect()}
    assert got == {f"w{i}": "w37" for i in range(37)}


def test_counts_are_exact_where_a_letter_is_frequent():
    rows = np.full((2, 5000), ord("e"), np.uint8)
    rows[1, 7] = ord("t")
    i, j = close_pairs(rows, rows, True)
    assert (i.tolist(), j.tolist()) == ([0], [1])
    assert one_edit(rows[i], rows[j]).all()
