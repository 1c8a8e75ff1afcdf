import random

import pytest
from pyspark.sql import functions as F

from tallybrook.llm.chat import format_chats, maximal_conversations
from tallybrook.llm.urls import RULES, judge_urls, template_tree

TURNS = "conv_id long, turn long, role string, text string, a string, chunk int, of int"


@pytest.fixture
def logged(spark):
    def make(conversations):
        rows = [
            (c, t, role, text, "x", 1, 2) for c, turns in conversations for t, (role, text) in turns
        ]
        return spark.createDataFrame(rows, TURNS)

    return make


def turns(*texts):
    return [(i, ("user" if i % 2 == 0 else "assistant", t)) for i, t in enumerate(texts)]


def test_only_maximal_conversations_are_rendered(logged):
    frame = logged(
        [
            (1, turns("hi", "hello", "bye")),
            (2, turns("hi", "hello")),
            (3, turns("hi")),
            (4, turns("hi", "hallo")),
            (5, turns("hi", "hello", "bye")),
            (6, turns("hello", "hi")),
            (7, [*turns("a", "b"), *turns("a")]),
            (8, [(0, (None, None)), (1, ("user", ""))]),
            (9, [(0, (None, None))]),
            (10, [(None, ("user", "first")), (0, ("user", "x")), (0, ("user", "w"))]),
            (None, turns("no", "id")),
        ]
    )
    got = {r.conv_id: (r.n_turns, r.text) for r in format_chats(frame).collect()}
    assert set(got) == {1, 4, 6, 7, 8, 10, None}
    assert got[7] == (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n")
    assert got[8][1] == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert got[10] == (3, "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in ("first", "w", "x")))
    assert format_chats(frame.limit(0)).collect() == []


def brute_maximal(conversations):
    whole = {c: tuple(sorted(set(t))) for c, t in conversations}
    return {
        c
        for c, t in whole.items()
        if not any(len(o) > len(t) and o[: len(t)] == t or o == t and d < c for d, o in whole.items())
    }


@pytest.mark.parametrize("chunk", [2, 3, 256])
def test_maximal_as_by_brute_force_whatever_the_chunks(logged, chunk):
    r = random.Random(3)
    many = [(c, [(i, ("user", r.choice("ab"))) for i in range(r.randint(1, 7))]) for c in range(60)]
    got = {x.conv_id for x in maximal_conversations(logged(many), chunk).collect()}
    assert got == brute_maximal(many)


def brute_rule(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None
    rest = url[at + 3 :]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = []
    for rule, verdict in RULES:
        of, start = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1] if fits else None


def test_urls_and_rules_as_by_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http://A.Com", "http://a.com/", "HTTP://EXAMPLE.com/en/x?y#z", "x://www.example.com/en/",
        "http://b.www.example.com/en/1", "http://example.com/EN/", "http://net/es/a", "http://x.net/fr", "http://x.net/fr/", "http://xnet/fr/",
        "http://a.com?u=http://b.net/es/", "http://a.net#/fr/", "ftp://İ.com/é/://", "http://a.com/\n/x", "://c.net/es/1", "http://a:80/" + "y" * 9000,
    ]
    pages = spark.createDataFrame([(i, u, "h", "p", "t", True) for i, u in enumerate(urls)], "page_id int, url string, host string, path string, template string, rejected boolean")
    got = {r.row.page_id: r for r in judge_urls(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule = brute_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (dict(RULES)[rule] if rule else "allow")
    assert judge_urls(pages.limit(0)).collect() == []


def test_variable_segments_become_wildcards(spark):
    rows = [("h", f"/blog/post-{a}{b}/view", 1) for a in "abcdef" for b in "ghi"] + [("h", "/about/us", 40), ("g", "/blog/post-x/view", 1)]
    tree = template_tree(spark.createDataFrame(rows, "host string, shape string, pages long"))
    got = {(r.host, r.template) for r in tree.collect()}
    assert got == {("h", "/blog/*/view"), ("h", "/about/us"), ("g", "/blog/post-x/view")}


def test_deep_segments_become_wildcards(spark):
    slugs = [f"{a}{b}" for a in "abcdef" for b in "ghi"]
    rows = [("five", f"/en/#/#/#/{s}", 1) for s in slugs] + [("six", f"/a/b/c/d/e/{s}/view", 1) for s in slugs]
    rows += [("five", "/en/#/#/x", 1), ("few", "/a/b/c/d/e/f/g", 1)]
    tree = template_tree(spark.createDataFrame(rows, "host string, shape string, pages long")).collect()
    assert len(tree) == len(rows)
    assert {(r.host, r.template) for r in tree} == {
        ("five", "/en/#/#/#/*"), ("six", "/a/b/c/d/e/*/view"), ("five", "/en/#/#/x"), ("few", "/a/b/c/d/e/f/g"),
    }


def test_templates_like_the_blocked_ones_are_rejected(spark):
    bad, good = (("bad.test/ads/", "block"), ("bad.test/news/", "allow"))
    urls = [f"http://bad.test/ads/{k}" for k in range(30)] + [f"http://bad.test/news/{k}" for k in range(30)]
    # The rule's path is longer than these, which have the same shape.
    urls += ["http://bad.test/ads/7?x", "http://other.test/ads/1"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = judge_urls(pages, (bad, good)).collect()
    purity = {(r.host, r.template): r.purity for r in rows}
    assert purity["bad.test", "/ads/#"] < 0.1 < 0.9 < purity["bad.test", "/news/#"]
    # 30 of 61 labels are good; nothing else is known of the other host.
    assert purity["other.test", "/ads/#"] == pytest.approx((30 + 2) / 65)
    narrow = (("bad.test/ads/1", "block"), ("bad.test/news/", "allow"))
    verdicts = {r.row.url: (r.rule, r.verdict) for r in judge_urls(pages, narrow).collect()}
    assert verdicts["http://bad.test/ads/2"] == (None, "block") and verdicts["http://other.test/ads/1"] == (None, "allow")


def test_templates_without_labels_are_judged_by_their_neighbours(spark):
    pages = [f"http://{h}.test/{branch}/{slug}" for h in ("mixed", "bad") for branch in ("a", "b") for slug in ("x", "y", "z")]
    pages += ["http://new.test/a/x", "http://mixed.test/a/x"]
    told = [(f"http://mixed.test/a/{s}", ok) for s, ok in (("x", True), ("y", True)) for _ in range(9)]
    told += [(f"http://mixed.test/b/{s}", False) for s in ("x", "y") for _ in range(9)]
    told += [(f"http://bad.test/a/{s}", False) for s in ("x", "elsewhere") for _ in range(20)] + [("http://bad.test/b/x", None), (None, True)]
    labels = spark.createDataFrame([(*t, 1) for t in told], "url string, good boolean, host int")
    rows = judge_urls(spark.createDataFrame([(u,) for u in pages], "url string"), (), labels).collect()
    assert len(rows) == len(pages)
    got = {r.row.url.removeprefix("http://"): (r.verdict, r.purity) for r in rows}
    # By the node's labels, by the host's where the node has none, by all where the host has none.
    assert [got[f"mixed.test/{b}/z"][0] for b in "ab"] == ["allow", "block"]
    assert [got[f"bad.test/{b}/z"][0] for b in "ab"] == ["block", "block"]
    share = (18 + 1 + 2) / (36 + 40 + 1 + 4)
    assert got["new.test/a/x"] == ("allow", pytest.approx(share)) and share < 0.4
    assert got["mixed.test/a/z"][1] > got["mixed.test/b/z"][1] > got["bad.test/a/z"][1]
    plain = judge_urls(spark.createDataFrame([(u,) for u in pages], "url string"), ()).collect()
    assert {(r.verdict, r.purity) for r in plain} == {("allow", 0.5)}
    assert len(judge_urls(spark.createDataFrame([(u,) for u in pages], "url string"), (), labels.limit(0)).collect()) == len(pages)


def test_a_shared_host_is_grouped_before_it_moves(spark):
    pages = spark.range(30_000).select(F.concat(F.lit("http://hot.net/de/"), "id").alias("url"))
    got = judge_urls(pages).groupBy("host", "template", "verdict").count().collect()
    assert [tuple(r) for r in got] == [("hot.net", "/de/#", "allow", 30_000)]
