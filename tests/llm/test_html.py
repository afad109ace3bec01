import collections
import itertools
import random
import re

import numpy as np

from quern.llm import html_content as H

SF = "/root/testdata/sf0.01"


def test_parser_survives_anything():
    assert [t for _, _, t in H.parse("<p>a<p>b &amp; c<li>d</div></p>e").texts] == ["a", "b & c", "d", "e"]
    d = H.parse("<ul><li>a<li>b</ul><script>if (a<b) x('</p>')</script>tail<!-- open")
    assert d.tag[:5] == ["", "ul", "li", "li", "script"] and d.parent[2] == d.parent[3] == 1
    assert d.texts[-1][2] == "tail"
    rng = random.Random(0)
    for _ in range(300):
        page = "".join(rng.choice(["<", ">", "</", "p", "div", " class='a b", '"', "x", "<!--", "-->", "<script>", "&#x;", "é", "<br/>", "<td>"]) for _ in range(30))
        d = H.parse(page)
        assert all(p < i for i, p in enumerate(d.parent))


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        parent = np.array([-1, *[int(rng.integers(0, i)) for i in range(1, n)]])
        score = rng.normal(size=n)
        _, levels = H._levels(parent)
        got = H.decode(score, parent, levels)
        value = lambda y: sum(s if b else -s for s, b in zip(score, y))
        fine = [y for y in itertools.product([False, True], repeat=n) if all(not y[i] or parent[i] < 0 or y[parent[i]] for i in range(n))]
        assert tuple(got) in fine and abs(value(got) - max(map(value, fine))) < 1e-9


def test_trees_learn_a_rule_and_keep_a_constant():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    m = H.boost(x[:2000], y[:2000])
    assert ((m.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.97
    assert (H.boost(x[:50], np.ones(50)).log_odds(x) > 0).all()


def _words(s):
    return set(re.findall(r"\w+", s.lower()))


def test_held_out_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.collect() if r["html"]]
    has = [h for _, h in rows if re.search("<(article|main)[ >]", h, re.I)]
    model = H.fit(has[::2])
    right = total = 0
    forest = H.features([H.parse(h) for h in has[1::2]])
    share, usable = H.marked(forest)
    picked = usable & (forest.own > 0)
    guess = model.log_odds(forest.x) > 0
    weight = forest.own[picked]
    right = ((guess == (share >= 0.5))[picked] * weight).sum()
    total = weight.sum()
    assert total and right / total > 0.9


def test_extracted_text(spark):
    """Of held-out pages, the extracted words are those that the pages' own marks call content."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").where("html IS NOT NULL")
    rows = [(r["page_id"], r["html"]) for r in pages.collect() if re.search("<(article|main)[ >]", r["html"], re.I)]
    model = H.fit([h for _, h in rows[::2]])
    held = spark.createDataFrame(rows[1::2], "page_id BIGINT, html STRING")
    got = {r["page_id"]: r["content"].split() for r in H.extract(held, model).collect()}
    right = found = wanted = 0
    for i, h in rows[1::2]:
        dom = H.parse(h)
        forest = H.features([dom])
        share, _ = H.marked(forest)
        want = [w for node, _, t in dom.texts if share[node] >= 0.5 for w in t.split()]
        both = collections.Counter(want) & collections.Counter(got[i])
        right, found, wanted = right + both.total(), found + len(got[i]), wanted + len(want)
    assert right > 0.85 * found and right > 0.85 * wanted


def test_pages_without_marks(spark):
    words = "The cat sat on the mat, and the dog looked at it for a long while. "
    page = lambda i: f"<html><body><div class=menu><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></div><div class=post><p>{words * (3 + i % 4)}</p><p>{words * 2}</p></div><div class=foot><a href=/c>Terms</a></div></body></html>"
    df = spark.createDataFrame([(i, page(i)) for i in range(40)], "page_id BIGINT, html STRING")
    for r in H.extract(df, H.train(df)).collect():
        assert words.split()[1] in r["content"] and "Terms" not in r["content"] and "About us" not in r["content"]
    long = spark.createDataFrame([(1, page(1))], "page_id BIGINT, html STRING")
    assert words.split()[1] in H.extract(long, H.train(long, longest=10)).first()["content"]


def test_odd_rows(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = H.train(pages)
    good = next(r["html"] for r in pages.orderBy("page_id").collect() if r["html"] and "<article" in r["html"])
    rows = [(1, good, "x"), (1, good, "x"), (2, "", "x"), (3, None, "x"), (None, good, "x"), (4, "just text", "x"), (5, "<div>" * 3000 + "deep" + "</div>" * 3000, "x"), (6, "<p>" + "long text here. " * 100_000, "x"), (7, "<<<>>><", "x")]
    df = spark.createDataFrame(rows, "page_id BIGINT, html STRING, content STRING")
    got = H.extract(df, model).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["content"] == by[None]["content"] and by[1]["content"]
    assert by[3]["content"] is None and by[2]["content"] == "" and by[3]["nodes"] == 0
    assert by[5]["nodes"] == 3000
    assert H.extract(df.limit(0), model).count() == 0
    nothing = H.train(df.limit(0))
    assert H.extract(df, nothing).count() == len(rows)
