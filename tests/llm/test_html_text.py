import html as entities
import itertools
import re

import numpy as np
import pytest

from relata.llm import dom, html_text
from relata.llm.catalog import op6_boosted_dom
from tests.conftest import SMALL


def plain(source):
    """The article of the given pages by patterns, which suffice for their one layout."""
    found = re.search(r"(?s)<article>(.*)</article>", source)[1]
    found = re.sub(r"</?(p|h1|h2|h3|ul|li|blockquote|table|tr|td)\b[^>]*>", "\x01", found)
    found = re.sub(r"<[a-zA-Z/!][^>]*>", "", found.replace("<br>", " "))
    return " ".join(filter(None, (" ".join(entities.unescape(x).split()) for x in found.split("\x01"))))


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.train(spark.read.parquet(f"{SMALL}/pages.parquet"))


def text_of(trees, source):
    page = dom.parse(source)
    return html_text.written(page, html_text.decode(page, trees.odds(html_text.node_features(page))))


def test_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    found = sorted(map(tuple, op6_boosted_dom(spark, SMALL).collect()))
    assert found == sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages)


EXTRA = [
    '<div class="sidebar"><h3>Related posts</h3><p>Some other words in here, quite long. Yes they are long.</p></div>',
    '<section id="comments"><div class="comment"><p>I liked this, thanks. Great read.</p></div></section>',
    '<div id="cookie-notice">We use cookies. Accept?</div>',
    "<form action=x><label>Name</label><input><p>Fill in please.</p></form>",
    '<nav class="menu"><a href="a">One</a> <a href="b">Two</a></nav>',
]


@pytest.mark.parametrize("extra", EXTRA)
def test_other_layouts(spark, trees, extra):
    source = spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").first().html
    article = re.search(r"(?s)<article>(.*)</article>", source)[1]
    for layout in (
        f"<html><body><header><h1>Site</h1></header><main>{article}</main>{extra}<footer>end</footer></body></html>",
        f'<html><body><div id="page"><div class="post">{article}{extra}</div></div></body></html>',
        f"<html><body>{extra}<div>{article}</div></body></html>",
        f"<body><article>{article}{extra}</article></body>",
    ):
        assert text_of(trees, layout) == plain(source)


def test_share_of_held_out_disguises(spark, trees):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    right = 0
    for number, row in enumerate(rows):
        page = dom.parse(html_text.disguised(row.html, 10**7 + number))
        wanted = html_text.written(page, html_text.known_labels(page).tolist())
        right += wanted == html_text.written(page, html_text.decode(page, trees.odds(html_text.node_features(page))))
    assert right / len(rows) > 0.85


def test_reader():
    page = dom.parse("<p>a<b>b &amp;amp; c<br>d<p>e<script>if(a<b){}</script>f < g<!-- <p> -->h<i class=x>i</i></div>j")
    runs = [(page.texts[n], page.blocks[n]) for n, tag in enumerate(page.tags) if tag == "#text"]
    assert html_text.written(page, [True] * len(page.tags)) == "ab &amp; c d e f < ghi j"
    assert [page.tags[page.parents[n]] for n, tag in enumerate(page.tags) if tag == "i"] == ["p"] and runs
    for odd in ("", "<", "<a", "</", "<p x='", "<!", "<!--", "&#0;&bogus;", "<script>", "<b><p></b></p></i>", "a\x00b", "<" * 5000, "<a b='" * 5000, "<p>" * 3000, "</p x" * 3000):
        dom.parse(odd)
    assert html_text.written(dom.parse("<li>a<li>b<td>c"), [True] * 99) == "a b c"


def test_decoding_is_the_best_consistent_choice():
    page = dom.parse("<div><p>a</p><p>b</p></div><ul><li>c</li></ul>")
    random = np.random.default_rng(3)
    for _ in range(30):
        odds = random.normal(size=len(page.tags))
        stays = html_text.decode(page, odds)
        best = max(
            (c for c in itertools.product((False, True), repeat=len(odds) - 1) if all((not s or ([True, *c][page.parents[n]])) for n, s in enumerate(c, 1))),
            key=lambda c: sum(odds[n] for n, s in enumerate(c, 1) if s),
        )
        assert stays == [True, *best]


def test_rows(spark, trees):
    long = "<article>" + "<p>Words of a text, as they are. More of them.</p>" * 5000 + "</article>"
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "", "x"), (None, None, long, "y"), (2, "v", "<p><p>", "z")], "page_id long, url string, html string, text string")
    rows = sorted(map(tuple, html_text.extract(pages, trees).collect()), key=str)
    assert [(r[0], r[1], r[3]) for r in rows] == [(1, "u", 0), (1, "u", 0), (2, "v", 0), (None, None, len("Words of a text, as they are. More of them. ") * 5000 - 1)]
    assert html_text.extract(pages.limit(0), trees).collect() == []
    assert html_text.train(pages.limit(0)) is not None


def test_formulas_drawings_and_choices_are_ordinary_elements(spark, trees):
    def all_of(source):
        page = dom.parse(source)
        return html_text.written(page, [True] * len(page.tags))

    assert all_of("<p>a <svg viewBox='0 0 1 1'/>b</p><p>c <math/>d</p><svg><path d=x /><title/></svg>e") == "a b c d e"
    assert all_of("<p>a<p><select><option>b<p>c</p>") == "a b c"
    assert all_of("<p>sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> here</p><p>d</p>") == "sum x+1 here d"
    assert all_of("<svg><foreignObject><div/>a</foreignObject><text>b</text></svg>c<svg><g><p>d<div>e</div>") == "a bc d e"
    page = dom.parse("<article><svg><g><p>a</p><p>b</p></article>")
    assert [page.tags[page.parents[n]] for n, tag in enumerate(page.tags) if tag == "p"] == ["article", "article"]
    for odd in ("<svg>" * 3000, "<svg/" * 3000, "<svg><foreignObject>" * 3000 + "<p>" * 3000, "<math></svg></math>", "<select>" * 3000):
        dom.parse(odd)
    source = spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").first().html
    for mark in ("<svg class='icon'/>", "<math/>", "<svg><path d='M0 0'/></svg>", "<svg><path d='M0 0'>", "<select>"):
        marked = re.sub(r"(<article>.*?<p\b[^>]*>)", lambda m: m[1] + mark, source, count=1, flags=re.DOTALL)
        assert marked != source and text_of(trees, marked) == plain(source), mark
    word = plain(source).split()[-1]
    at = source.rindex(word, 0, source.rindex("</article>"))
    marked = source[:at] + "<math><mi>x</mi></math> " + source[at:]
    assert text_of(trees, marked) == plain(marked)
