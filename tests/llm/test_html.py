from __future__ import annotations

import numpy as np

from ferryline.llm import html_extract as extract
from ferryline.llm.boosting import fit
from ferryline.llm.html_dom import Dom

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><div class="ad">Buy this now.</div>
<article><h1>Head &amp; line</h1><p><b>First  block
of text, with some words in it.<br><p>Second block, <i>also</i> with words &lt;here&gt;.</p></article>
<div id="comments"><div class="comment"><p>I think this is a comment, quite a long one.</p></div></div>
<footer>&copy; somebody &middot; all of it.</footer></body></html>"""


def test_article_alone_is_kept():
    assert extract.main_text(PAGE, extract.trained()) == (
        "Head & line\nFirst block of text, with some words in it.\nSecond block, also with words <here>."
    )


def test_made_pages_that_were_not_trained_on():
    maker, wrong, all_ = extract.PageMaker(12345), 0, 0
    for _ in range(60):
        html = maker.page()
        dom, (_, keep) = Dom(html), extract.labelled(html)
        kept = dom.decode(extract.trained().margin(dom.features()))
        for i, _, text in dom.texts:
            size = len(text.strip())
            all_ += size
            wrong += size * (kept[i] != bool(keep[i]))
    assert wrong < 0.02 * all_


def test_choices_never_contradict():
    r = np.random.default_rng(1)
    dom = Dom(extract.PageMaker(5).page())
    for _ in range(50):
        margin = r.normal(0, 2, len(dom.tags))
        kept = dom.decode(margin)
        assert all(not kept[i] or kept[dom.parents[i]] for i in range(1, len(kept)))


def test_decoding_is_the_best_choice():
    """Against every consistent choice on small trees."""
    r = np.random.default_rng(2)
    dom = Dom("<div><p>a<b>c</b></p><ul><li>x</li><li>y</li></ul></div>")
    n = len(dom.tags)
    for _ in range(40):
        margin = r.normal(0, 2, n)
        keep, drop = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
        worth = lambda c: sum(keep[i] if c[i] else drop[i] for i in range(n))  # noqa: B023, E731
        choices = ([bool(k >> i & 1) for i in range(n)] for k in range(2**n))
        best = max(worth(c) for c in choices if all(not c[i] or c[dom.parents[i]] for i in range(1, n)))
        assert np.isclose(worth(dom.decode(margin)), best)


def test_edge_cases(spark):
    deep = "<div>" * 3000 + "deep words, in a deep place." + "</div>" * 3000
    rows = [
        (1, "u", None),
        (2, None, ""),
        (None, "u", "plain words with no markup at all, and a mark."),
        (4, "u", PAGE),
        (4, "u", PAGE),
        (5, "u", "<article><p>cut off in the mid<scr"),
        (6, "u", "</p></div><<>>&bogus; &#x; <script>never ends"),
        (7, "u", deep),
        (8, "u", "<article>" + "<p>word after word, again and again.</p>" * 20_000 + "</article>"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").repartition(2)
    found = extract.digest(extract.extract(pages)).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    by = {(r.page_id, r.url): r.text for r in found}
    assert by[(1, "u")] == by[(2, None)] == ""
    assert by[(4, "u")].startswith("Head & line\n") and sum(r.page_id == 4 for r in found) == 2
    assert by[(8, "u")].count("\n") == 19_999
    assert extract.extract(pages.where("false")).count() == 0


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = fit(x[:2000], y[:2000], np.ones(2000), rounds=30, depth=3)
    assert (((trees.margin(x[2000:]) > 0) == y[2000:]).mean()) > 0.95
