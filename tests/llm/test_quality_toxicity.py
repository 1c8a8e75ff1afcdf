import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybrook.llm.quality import COUNTS, RULES, fit_votes, judged, keep_good, quality_counts
from tallybrook.llm.toxicity import (
    EDGE,
    LETTERS,
    Features,
    Model,
    feature_hashes,
    fit,
    held_out,
    keep_civil,
    letter_codes,
    letter_model,
    letter_readings,
    likeliest,
    plain_words,
    prefix_hashes,
    readings,
    restore,
    restored_texts,
    spaced_hashes,
    text_features,
    toxicity,
    ways,
    word_counts,
)
from tallybrook.session import session_settings

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


def test_counts_as_by_brute_force(documents, texts):
    r = random.Random(2)
    many = [*texts, "a b c a b c", "a a a a", "x\n x\nx\n\n\n", "# $ % |", "a\x0bb\x0cc\rd"]
    many += ["\n".join(" ".join(r.choice("abcd") for _ in range(r.randint(0, 5))) for _ in range(r.randint(1, 9))) for _ in range(60)]
    docs = documents(many)
    rows = quality_counts(docs).collect()
    assert len(rows) == docs.count()
    for x in rows:
        expected = brute_counts(x.row.text)
        assert {k: x.counts[k] for k in expected} == expected


def junk(prose, seed, n, kind):
    words = prose(seed, n).split()
    r = random.Random(seed)
    return {
        "symbols": " ".join(w + r.choice(("###", "&&&", "***")) for w in words),
        "capitals": " ".join(w.upper() + "!!" for w in words),
        "pipes": " | ".join(words),
        "repeated": " ".join([words[0]] * n),
        "lines": "\n".join([" ".join(words[:9])] * 12),
    }[kind]


def test_clean_documents_stay_and_junk_goes(documents, prose):
    kinds = ["symbols", "capitals", "pipes", "repeated", "lines"]
    clean = [prose(s, 60 + 5 * s) for s in range(80)]
    bad = [junk(prose, s, 80, kinds[s % 5]) for s in range(20)]
    docs = documents([*clean, *bad, prose(1, 20), "", None])
    rows = {r.row.doc_id: r for r in judged(quality_counts(docs)).collect()}
    assert all(rows[i].kept for i in range(80)) and not any(rows[i].kept for i in range(80, 103))
    kept = keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(80))
    assert keep_good(docs.limit(0)).collect() == []


def test_votes_of_known_accuracies_are_told_apart():
    r = random.Random(4)
    accuracy = [(0.98, 0.9), (0.95, 0.6), (0.99, 0.5)]
    patterns, truth = Counter(), {}
    for _ in range(4_000):
        good = r.random() < 0.8
        votes = [r.random() < (a if good else 1 - b) for a, b in accuracy]
        pattern = sum(2 * v * 3**k for k, v in enumerate(votes))
        patterns[pattern] += 1
        truth.setdefault(pattern, []).append(good)
    posterior = fit_votes(dict(patterns), 3)
    for pattern, found in truth.items():
        if len(found) > 100:
            assert abs(posterior[pattern] - np.mean(found)) < 0.15
    assert fit_votes({}) == {} and fit_votes({2 * sum(3**k for k in range(len(RULES))): 5}) != {}
    assert set(fit_votes({26: 9, 13: 1}, 3).values()) == {1.0}


def test_letters_of_all_texts_are_counted(documents, texts):
    docs = documents(texts)
    words = Counter()
    for t in [*texts, *[texts[0]] * 2, *["a text without an id"] * 2]:
        for w in filter(None, SPACE.split(t or "")):
            w = w.lower().strip(".,;:!?\"'()")
            if w.isalpha():
                words[w] += 1
    got = {r.word: r.n for r in word_counts(docs).collect()}
    assert got == dict(words)
    model = letter_model(word_counts(docs))
    assert model.shape == (LETTERS,) * 3 and np.allclose(np.exp(model.astype(float)).sum(2), 1, atol=1e-4)
    counts = Counter()
    for w, n in words.items():
        codes = [EDGE, EDGE, *letter_codes(w), EDGE]
        counts.update({k: n for k in zip(codes, codes[1:], codes[2:], strict=False)})
    assert model[tuple(max(counts, key=counts.get))] > np.log(0.2)


def test_a_task_sums_up_its_words_again_and_again(spark, monkeypatch):
    monkeypatch.setattr("tallybrook.llm.toxicity.GATHERED", 10)
    few, many = ["Ab cd, ab 9", "ef x1 ab", None, ""], [" ".join(a + b for b in "abcdefgh") for a in "qrstuvw"]
    # Sums that are held and summed again, sums too many to be held, and some held after these.
    lines = few * 8 + many * 2 + few * 8
    words = Counter(w for t in lines for w in (t or "").lower().replace(",", "").split() if w.isalpha())
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        docs = spark.createDataFrame([(t,) for t in lines], "text string").coalesce(1)
        got = {r.word: r.n for r in word_counts(docs).collect()}
    assert got == dict(words)


@pytest.fixture(scope="module")
def model(spark):
    words = "idiot moron loser stupid worthless the lot of total model roots tomato moon good is it to on".split()
    return letter_model(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))


@pytest.mark.parametrize(
    "written, meant",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"),
     ("w-o-r-t-h-l-e-s-s", "worthless"), ("gooood", "good"), ("moon", "moon"), ("", "")],
)
def test_words_are_restored(model, written, meant):
    assert restore(written, model) == meant


@pytest.mark.parametrize(
    "letters, meant",
    [("totalidiot", "total idiot"), ("thelotofmoron", "the lot of moron"), ("isstupid", "is stupid"),
     ("itist0t4lm0r0n", "it is total moron"), ("idiot", "idiot"), ("", "")],
)
def test_spaced_words_are_parted(model, letters, meant):
    assert restore(letters, model, spaced=True) == meant


@pytest.mark.parametrize(
    "written, meant",
    [("iidiot", "idiot"), ("sstupid", "stupid"), ("mmorron", "moron"), ("M00RR0N", "moron"), ("!!d!ot", "idiot"), ("moon", "moon"),
     ("éé", "é"), ("10$3r", "loser"), ("105", "los"), ("lo$$", "loss"), ("moron$$", "moron"), ("moron", "moron")],
)
def test_every_odd_word_is_decoded(model, written, meant):
    _, restored, other = plain_words(pa.array([written]), Model(model), {})
    assert meant in (restored[0].as_py(), other[0].as_py())


def every_reading(word, doubled):
    """All letters that a word may stand for, with what each choice costs in the channel."""
    out = [("", 0.0)]
    for char, run in itertools.groupby(word):
        meant = ways(char, len(list(run)), doubled)
        out = [(text + c, cost + more) for text, cost in out for c, more in meant]
    return out


def letter_cost(text, model):
    codes = [EDGE, EDGE, *letter_codes(text), EDGE]
    return -sum(float(model[a][b][c]) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))


@pytest.mark.parametrize("doubled", [4.0, 0.0])
def test_the_search_finds_the_cheapest_of_all_readings(model, doubled):
    r = random.Random(int(doubled))
    words = ["".join(r.choice("aost0015$!-.|ll") for _ in range(r.randint(1, 7))) for _ in range(300)] + ["", "aaa", "100", "$$$"]
    for word in words:
        cost, text = likeliest(word, model, doubled=doubled)
        best = {}
        for letters, channel in every_reading(word, doubled):
            best[letters] = min(best.get(letters, math.inf), channel + letter_cost(letters, model))
        assert math.isclose(cost, min(best.values()), abs_tol=1e-6)
        assert math.isclose(best[text], cost, abs_tol=1e-6)


def test_words_of_letters_are_read_together_as_one_by_one(model):
    r = random.Random(3)
    words = ["".join(r.choice("moronéß") * r.choice((1, 1, 1, 2, 2, 3)) for _ in range(r.randint(1, 8))) for _ in range(400)]
    words += ["iidiot", "moon", "éé", "aaaa", "mmoorroonn"]
    assert letter_readings(words, model) == [readings(w, model.tolist()) for w in words]
    assert letter_readings([], model) == []


def test_signs_at_the_end_are_noise_or_letters(spark):
    words = [("ass", 5), ("dumbass", 5), ("a", 500), ("good", 50), ("to", 50), ("is", 50)]
    model = letter_model(spark.createDataFrame(words, "word string, n long"))
    written = ["a$$", "dumba$$", "@$$", "455", "good$$$", "$$$", "22", "a"]
    body, restored, other = plain_words(pa.array(written), Model(model), {})
    both = dict(zip(written, zip(restored.to_pylist(), other.to_pylist(), strict=True), strict=True))
    assert all("ass" in both[w] for w in ("a$$", "@$$", "455")) and "dumbass" in both["dumba$$"]
    assert both["good$$$"][0] == "good" and both["22"] == ("22", "22") and both["455"][0] == "455" and both["a"] == ("a", "a")
    hashes, rows, changed = text_features(Features(model), pa.array(["to a$$", "good $$$"]))
    assert {h[0] for h in feature_hashes(pa.array(["ass"], pa.large_string()))} <= set(hashes[rows == 0].tolist())


def test_every_word_of_a_spaced_phrase_is_seen(model):
    features = Features(model)
    texts = pa.array(["so i t i s t o t a l i d i o t I S M 0 R 0 N.\ngood moon", "a b c", None, "x " * 30_000])
    hashes, rows, changed = text_features(features, texts)
    seen = set(hashes[rows == 0].tolist())
    for word in ("total", "idiot", "moron"):
        assert {h[0] for h in feature_hashes(pa.array([word], pa.large_string()))} <= seen
    assert changed.tolist() == [0, 3]
    assert restored_texts(texts, features, changed)[0].as_py() == "so it is total idiot is moron\ngood moon"
    # Also where no end of a word is found.
    letters = spaced_hashes([(0, 0, "youidiot", "youidiot")])[0]
    assert prefix_hashes(pa.array(["idiot"]), (5,))[0][0] in np.concatenate(letters)


def test_toxic_words_are_learned_also_when_hidden(spark, prose):
    r = random.Random(8)
    slurs = ["vorgak", "snulpit", "drekkolo"]
    hidden = {"vorgak": "v0rg4k", "snulpit": "snuuuulpit", "drekkolo": "d r e k k o l o"}
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 60).split()
        toxic = i % 5 == 0
        if toxic:
            slur = slurs[i % 3]
            words.insert(r.randint(0, 60), hidden[slur] if i > 700 else slur)
        rows.append((i, " ".join(words), i % 7, None))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None, 1, 1), (901, "", 1, 1), (901, "", 1, 1)], "doc_id long, text string, score int, restored int")
    known = spark.createDataFrame([*labels, (None, 1), (5_000, 1), (3, None)], "doc_id long, toxic int")
    scored = {x.row.doc_id: x for x in toxicity(docs, fit(docs, known), restored=True).collect()}
    assert len(scored) == 902 and all(0 <= x.score <= 1 for x in scored.values())
    outside = [(i, t) for i, t in labels if i in {x.i for x in spark.createDataFrame(labels, "i long, t int").where(held_out(F.col("i"))).collect()}]
    right = [(scored[i].score >= 0.3) == bool(t) for i, t in outside]
    assert len(outside) > 100 and np.mean(right) > 0.97
    assert "vorgak" in scored[705].restored and scored[1].restored is None
    civil = keep_civil(docs, known)
    assert civil.columns == docs.columns and civil.where("doc_id = 901").count() == 2
    assert {x.doc_id for x in civil.collect()} == {i for i, x in scored.items() if x.score < 0.3}
    nothing = toxicity(docs.limit(5), fit(docs.limit(0), known.limit(0))).collect()
    assert len({x.score for x in nothing}) == 1 and nothing[0].score < 0.3


def test_no_task_needs_two_python_workers(spark, prose, plan, monkeypatch):
    from tallybrook.llm import toxicity as module

    made, steps = module.map_batches, []

    def watched(df, function, schema):
        steps.append(plan(df).split("Exchange")[0])
        return made(df, function, schema)

    monkeypatch.setattr(module, "map_batches", watched)
    docs = spark.createDataFrame([(i, prose(i, 30) + " vorgak" * (i % 2)) for i in range(60)], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    _, features, _ = fit(docs, known)
    assert len(features.value) and len(steps) >= 4
    assert not [step for step in steps if "MapInArrow" in step]


def test_hold_out_follows_the_checksum(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 4 == 2 for r in rows]
    assert len(COUNTS) == 8
