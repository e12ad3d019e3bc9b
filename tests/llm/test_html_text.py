"""Main text of pages: blocks by hand, the network's gradient, labels held out, whole pages against a plain reader."""

import html
import random
import re
import time

import numpy as np
import pytest

from fieldloom.llm import html_text as ht
from fieldloom.llm.queries import op13_html


def texts(page):
    return [b.text for b in ht.blocks(page, ht.Paths())]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []), ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<p>b", ["a", "b"]), ("<p>a<br>b</p>", ["a b"]), ("<p> a \n\t b&nbsp; c</p>", ["a b c"]),
        ("<p><b>x</b>y <i>z</i></p>", ["xy z"]), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("<script>var t='</p>';<p>x</script>y", ["y"]), ("<style>p{}</style><title>t</title>a<!-- <p>b --><p>c", ["a", "c"]), ("a<script>never closed <p>b", ["a"]), ("a<!-- never closed <p>b", ["a"]),
        ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]), ("<a href='x>y'>l</a>", ["l"]), ('<div class="a>b" id=c>t</div>', ["t"]), ("<p>a &lt;b&gt; &#233; &eacute; &am</p>", ["a <b> é é &am"]), ("<p>cut <b", ["cut"]), ("a<!-- open", ["a"]), ("5 < 6", ["5 < 6"]),
        ("<div>a</p>b</span></div></div>c", ["a", "b", "c"]), ("<P CLASS=X>a</P>", ["a"]), ("<!DOCTYPE html><?xml?>x", ["x"]), ("<select><option>1</select><button>b</button><textarea>t</textarea>z", ["z"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_fade_and_are_shared():
    paths = ht.Paths()
    a, b = ht.blocks("<div class='x y'><p>1</p></div><div class='x y'><p>2</p></div>", paths)
    assert a.node is b.node and a.node.vector.max() == 1 and 0 < (a.node.vector < 1).sum()


@pytest.mark.parametrize("unit", ["<p>", "<div>", "<a ", "<a ='", "<!", "<!--", "<b>", "</i>", "&amp", "<script>", '<a ="', "</div><p>", "<li>", "< "])
def test_time_grows_with_the_page(unit):
    began = time.process_time()
    ht.blocks(unit * 100_000, ht.Paths())
    ht.blocks(unit * 100_000 + ">", ht.Paths())
    assert time.process_time() - began < 5


def test_gradient():
    r = np.random.default_rng(0)
    model = ht.Labeller(1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, y, mask = r.standard_normal((5, 3, ht.INPUTS)) * 0.3, r.integers(0, 2, (5, 3)).astype(float), np.ones((5, 3))
    mask[3:, 1] = mask[2:, 2] = 0
    _, g = model.gradient(x, y, mask)
    for name, v in model.p.items():
        at = tuple(r.integers(0, n) for n in v.shape)
        keep, sides = v[at], []
        for step in (1e-3, -1e-3):
            v[at] = keep + step
            sides.append(model.gradient(x, y, mask)[0])
        v[at] = keep
        assert np.isclose((sides[0] - sides[1]) / 2e-3, g[name][at], rtol=2e-2, atol=2e-5), name


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def htmls(pages):
    return [r.html for r in pages.orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(htmls):
    return ht.fit_pages(htmls[::2])


def article(page):
    """The text of the one article that the test pages have, by string functions."""
    body = page.split("<article>", 1)[1].split("</article>", 1)[0]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
    return "\n".join(filter(None, parts))


def read(model, page):
    found = ht.blocks(page, ht.Paths())
    return "\n".join(b.text for b, c in zip(found, model.chances([found])[0], strict=True) if c >= 0.5)


def test_held_out_pages(model, htmls):
    held = htmls[1::2]
    assert sum(read(model, h) == article(h) for h in held) >= 0.99 * len(held)


def test_held_out_layouts(model, htmls):
    """Pages laid out anew, from texts that were not fitted: blocks labelled right."""
    paths, r = ht.Paths(), random.Random(77)
    mains = [article(h).split("\n") for h in htmls[1::2]]
    spare = [t for m in mains for t in m if len(t) < 300]
    again = [ht.layout(m, spare, paths, r) for m in mains]
    chances = model.chances([p for p, _ in again])
    right = sum(int(((c >= 0.5) == np.array(own)).sum()) for c, (_, own) in zip(chances, again, strict=True))
    assert right >= 0.96 * sum(len(own) for _, own in again)


def test_other_make_of_page(model):
    prose = [f"This is sentence {i} of a long report, which goes on about several matters of interest, and ends here." for i in range(6)]
    page = f"""<html><body><div class=cookie-notice><p>We use cookies to improve your experience.</p></div><div class="header"><ul class=menu><li><a href=/>Home</a><li><a href=/a>About</a></ul></div>
    <div class="content"><h1>A report</h1>{''.join(f'<p>{t}</p>' for t in prose)}</div><div class="sidebar"><p><a href=/b>Related articles</a></p></div>
    <div class="comments"><div class="comment"><p>Great article!</p></div></div><form class=newsletter><p>Subscribe to our newsletter</p></form><div class="footer">All rights reserved.</div></body></html>"""
    assert read(model, page) == "\n".join(["A report", *prose])


def test_batching_changes_nothing(model, htmls, monkeypatch):
    paths = ht.Paths()
    parsed = [ht.blocks(h, paths) for h in htmls[:40]] + [[]]
    together = model.chances(parsed)
    monkeypatch.setattr(ht, "TOGETHER", 1)
    for a, b in zip(together, model.chances(parsed), strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_query(spark, sf_dir):
    rows = op13_html(spark, sf_dir).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages) and all(r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in rows)
    assert sum(r.text == article(pages[r.page_id].html) for r in rows) >= 0.96 * len(rows)
    assert rows == op13_html(spark, sf_dir).collect()  # the same network in each run


def test_awkward_pages(spark):
    long = "<article>" + "<p>one more line of text, quite like the others.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, 1), (2, None, "", 1), (3, "u", "<nav></nav>", 1), (None, "u", long, 1), (4, "u", "no markup at all", 1), (4, "u", "no markup at all", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = ht.extract(df, ht.fit(df)).collect()
    assert len(out) == 6 and all(r.text == "" for r in out if r.page_id in (1, 2, 3))
    assert [r for r in out if r.page_id is None][0].n_chars >= 0
    only_long = df.filter("page_id IS NULL")  # none to fit on
    assert ht.extract(only_long, ht.fit(only_long)).first().text.count("\n") == 19_999
    none = df.limit(0)
    assert ht.extract(none, ht.fit(none)).columns == ["page_id", "url", "text", "n_chars"] and ht.extract(none, ht.fit(none)).count() == 0
