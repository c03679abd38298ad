import itertools
import time

import numpy as np
import pytest

from affinary.llm import host_trust, html_text
from affinary.llm.host_trust import Rule

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div id="cookie-notice">We use cookies. Accept them all please.</div><!-- <p>gone</p> --><article><h1>Head &amp; line</h1>
<p><b>First   paragraph
of&nbsp;text.<br><p>Second &lt;one&gt;.</p><p>Short</p><div class="ad">Buy now.</div><div class="comments"><p>Nice one. I liked it a lot.</p></div></article>
<aside><p>Related things.</p></aside><form><p>Sign up now.</p></form><footer>&copy; 2020 by us.</footer></body></html>"""


def test_article_alone_is_kept():
    assert html_text.main_text(PAGE) == "Head & line\nFirst paragraph of text.\nSecond <one>.\nShort"
    without_article = PAGE.replace("article>", "div>").replace("<p>Second", "<p>" + "Many words make up a long paragraph. " * 8 + "</p><p>Second")
    text = html_text.main_text(without_article)
    assert "Many words" in text and "Second <one>." in text and "cookies" not in text and "Related" not in text and "2020" not in text


@pytest.mark.parametrize("html", ["", "plain text", "<", "<p", "<!--", "<a href='x>y", "</p></div>", "<script>x", "&#1234567890;&bogus;", "<p>" * 3000])
def test_odd_markup(html):
    assert isinstance(html_text.main_text(html), str)


ARTICLE = "<h1>A title</h1>" + "".join(f"<p>Sentence {i} of the article has some words. Another one.</p>" for i in range(5))
WRAPPERS = [
    '<div class="content with-sidebar">', '<div class="post more">', '<div class="legal-content">', '<div class="story header">',
    '<div class="has-sidebar">', '<div class="no-header">', '<main class="main sidebar-right">', '<div id="search">', '<body class="search">',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers_with_boilerplate_names_keep_the_article(wrapper):
    tag = wrapper[1:].split()[0]
    page = f'<html><div class="menu"><a href="x">Home</a></div>{wrapper}{ARTICLE}</{tag}><div class="footer">All rights are ours.</div></html>'
    text = html_text.main_text(page)
    assert text.startswith("A title\nSentence 0") and text.count("\n") == 5 and "rights" not in text and "Home" not in text


def test_boilerplate_with_good_names_goes():
    comments = "".join(f'<div class="comment-content"><p>Comment {i} is longer than the article. Yes.</p></div>' for i in range(30))
    page = f'<div class="content">{ARTICLE}</div><div class="comments">{comments}</div><div class="sidebar content"><p>Read this too.</p></div>'
    text = html_text.main_text(page)
    assert "Sentence 4" in text and "Comment" not in text and "Read this" not in text


LONG_PAGES = {
    "blocks": "".join(f"<p>{'word ' * (i * 7 % 13 + 1)}</p><li><a href=x>{'w ' * (i * 5 % 6)}</a> {'z ' * (i * 3 % 9)}</li>" for i in range(40_000)),
    "nested": "<div>t " * 100_000,
    "inline": "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000,
    "fronts": "<p>a.</p>" + "<a" * 300_000,
    "items": "<ul>" * 1000 + "<li>x y" * 50_000,
}


@pytest.mark.parametrize("name", LONG_PAGES)
def test_long_pages_take_linear_time(name):
    begun = time.process_time()
    html_text.main_text(LONG_PAGES[name])
    assert time.process_time() - begun < 30  # quadratic time takes many minutes


def test_rows_of_pages(spark):
    frame = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE, "x")], "page_id bigint, url string, html string, text string")
    found = html_text.extract(frame).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, len(html_text.main_text(PAGE)))] * 1 + [(1, len(html_text.main_text(PAGE))), (2, 0)]
    assert html_text.extract(frame.limit(0)).count() == 0


def cut_value(side, content, boiler, edges):
    # an element on the source's side pays its edge to the sink
    return sum(boiler[i] if s else content[i] for i, s in enumerate(side)) + sum(c for a, b, c in edges if side[a] != side[b])


@pytest.mark.parametrize("seed", range(12))
def test_minimum_cut_is_minimal(seed):
    random = np.random.default_rng(seed)
    n = int(random.integers(1, 9))
    content, boiler = random.uniform(0, 3, n).tolist(), random.uniform(0, 3, n).tolist()
    edges = [(i, j, float(random.uniform(0, 1.5))) for i, j in itertools.combinations(range(n), 2) if random.random() < 0.5]
    found = html_text.minimum_cut(content, boiler, edges)
    least = min(cut_value(side, content, boiler, edges) for side in itertools.product([False, True], repeat=n))
    assert cut_value(found, content, boiler, edges) == pytest.approx(least)


def test_minimum_cut_of_long_chains():
    # a chain is cut as cheaply as the best labelling found along it, block by block
    random = np.random.default_rng(5)
    for n, scale in ((3000, 0.3), (3000, 2.0), (500, 0.01)):
        content, boiler = random.uniform(0, scale, n).tolist(), random.uniform(0, scale, n).tolist()
        edges = [(i, i + 1, float(random.uniform(0, 1.0))) for i in range(n - 1)]
        kept, gone = boiler[0], content[0]
        for i in range(1, n):
            edge = edges[i - 1][2]
            kept, gone = min(kept, gone + edge) + boiler[i], min(gone, kept + edge) + content[i]
        assert cut_value(html_text.minimum_cut(content, boiler, edges), content, boiler, edges) == pytest.approx(min(kept, gone))


RULES = [Rule("allow", "good.example/"), Rule("block", "bad.example/"), Rule("block", "good.example/en/1"), Rule("allow", "x.good.example/en/1")]


def pages(spark, given):
    rows = [(i, url, html, "clash", "clash") for i, (url, html) in enumerate(given)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, trust string, host string").drop("host")


def test_parts_and_rules(spark):
    given = [
        ("HTTP://A.Good.Example/en/12?q#f", None),
        ("https://good.example", None),
        ("https://xgood.example/en", None),
        ("//good.example/", None),
        (None, None),
        ("http://good.example/en/1x", None),
        ("a://b://c/d", None),
        ("http://x.good.example/en/1", None),
        ("http://ÀB.example/p", None),
    ]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in host_trust.judge(pages(spark, given), RULES).collect()}
    assert found == {
        0: ("a.good.example", "/en/12", "good.example/en/1", "block"),
        1: ("good.example", "", None, "block"),  # of this host's pages, rules only block one
        2: ("xgood.example", "/en", None, "allow"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("good.example", "/en/1x", "good.example/en/1", "block"),
        6: ("b:", "//c/d", None, "allow"),
        7: ("x.good.example", "/en/1", "x.good.example/en/1", "allow"),
        8: ("Àb.example", "/p", None, "allow"),
    }
    assert host_trust.judge(pages(spark, []), RULES).count() == 0


def plain_scores(seeds, links, follow, steps):
    hosts = sorted({h for h in seeds} | {h for e in links for h in e})
    out, into = {}, {}
    for (a, b), n in links.items():
        out[a] = out.get(a, 0) + n
        into[b] = into.get(b, 0) + n
    trust = {h: (1 - follow) * seeds.get(h, (0, 0))[0] for h in hosts}
    distrust = {h: (1 - follow) * seeds.get(h, (0, 0))[1] for h in hosts}
    for _ in range(steps):
        t = {h: (1 - follow) * seeds.get(h, (0, 0))[0] for h in hosts}
        d = {h: (1 - follow) * seeds.get(h, (0, 0))[1] for h in hosts}
        for (a, b), n in links.items():
            t[b] += follow * trust[a] * n / out[a]
            d[a] += follow * distrust[b] * n / into[b]
        trust, distrust = t, d
    return {h: (trust[h], distrust[h]) for h in hosts}


def test_scores_that_never_settle_are_refused(spark):
    for follow, tolerance in ((1.0, 1e-6), (0.85, 0.0)):
        with pytest.raises(ValueError):
            host_trust.spread(None, None, follow, None, tolerance)


def test_scores_spread_over_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">t</a>' for h in hosts)
    given = [
        ("http://good.example/", link("friend.example", "friend.example", "other.example", "good.example")),
        ("http://friend.example/", link("OTHER.example:80") + '<a href=//user@second.example/>'),
        ("http://spam.example/", link("bad.example", "bad.example", "farm.example")),
        ("http://farm.example/", link("spam.example")),
        ("http://bad.example/", link("friend.example")),
        ("http://other.example/a", None),
        ("http://second.example/a", ""),
    ]
    links = {
        ("good.example", "friend.example"): 2, ("good.example", "other.example"): 1, ("friend.example", "other.example"): 1, ("friend.example", "second.example"): 1,
        ("spam.example", "bad.example"): 2, ("spam.example", "farm.example"): 1, ("farm.example", "spam.example"): 1, ("bad.example", "friend.example"): 1,
    }
    expected = plain_scores({"good.example": (1.0, 0.0), "bad.example": (0.0, 1.0)}, links, 0.85, 400)
    # spam and farm link to each other, so 32 rounds would leave them short of their scores
    found = {r.host: r for r in host_trust.judge(pages(spark, given), RULES).collect()}
    for host, row in found.items():
        assert (row.trust, row.distrust) == pytest.approx(expected[host], abs=1e-5)
    verdicts = {h: r.verdict for h, r in found.items()}
    assert verdicts == {
        "good.example": "allow", "friend.example": "allow", "other.example": "allow", "second.example": "allow",
        "spam.example": "block", "farm.example": "block", "bad.example": "block",
    }
