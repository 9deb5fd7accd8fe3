from __future__ import annotations

import random
from html.parser import HTMLParser

import numpy as np
import pytest

from pyspark.sql import functions as F

from salesloom.llm import common, page_text
from salesloom.llm.page_blocks import Block, blocks
from salesloom.llm.queries import QUERIES
from tests.conftest import DATA


def texts_of(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_damaged_and_nested_markup():
    assert texts_of("<p>a<p>b <b>c</b> d<br>e&amp;amp;&nbsp;f</p>tail<ul><li>x<li>y</ul>") == ["a", "b c d e&amp; f", "tail", "x", "y"]
    assert texts_of("<table><tr><td>1<td>2<tr><th>3</table>&copy; &#x41;&unknown; 1 < 2") == ["1", "2", "3", "© A&unknown; 1 < 2"]
    assert texts_of("<head><title>t</title><p>body begins<script>var x = '<p>no</p>';</SCRIPT> and goes on") == ["body begins and goes on"]
    assert texts_of("<!-- <p>no --><style>p{}</style><p title='a > b'>yes</p><!-- open <p>no") == ["yes"]
    assert texts_of("<p>one\n\ttwo  three</p><select><option>no</select><button>no</button><p>end<div") == ["one two three", "end"]
    assert texts_of("") == [] and texts_of("plain text") == ["plain text"] and texts_of("</p></div>x</b>") == ["x"]
    block = blocks('<body><div class="siteFooter x-y" id=main><p>see <a href="#">here</a></div>')[0]
    assert block == Block((("body",), ("div", "site", "footer", "x", "y", "main"), ("p",)), "see here", 4)
    deep = texts_of("<div>" * 3000 + "deep" + "</div>" * 3000)
    assert deep == ["deep"]


def test_gradients_equal_differences():
    chance = random.Random(1)
    pages = [page_text.composed([["some text here. more"]], chance) for _ in range(3)]
    model = page_text.Labeller.fresh(3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    page = page_text.encoded([[b for b, _ in p] for p in pages], {})
    labels = np.array([y for p in pages for _, y in p], float)

    def loss():
        z = model.logits(page)
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    found = model.gradients(page, labels)
    numbers = np.random.default_rng(2)
    for name, d in found.items():
        for flat in np.argsort(-np.abs(d).ravel())[:3].tolist() + numbers.integers(0, d.size, 2).tolist():
            place = np.unravel_index(flat, d.shape)
            held = model.weights[name][place]
            high, low = held + 1e-3, held - 1e-3
            model.weights[name][place] = high
            above = loss()
            model.weights[name][place] = low
            below = loss()
            model.weights[name][place] = held
            assert abs((above - below) / 2e-3 - d[place]) < 1e-4, name


class Article(HTMLParser):
    """Text of the article element by the library's parser, cut at block elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag not in ("b", "br", "a"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag not in ("b", "br", "a"):
            self.blocks.append("")
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def article(page):
    parser = Article()
    parser.feed(page)
    parser.close()
    return "\n\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)


def test_query_gives_the_article_of_every_given_page(spark):
    data = DATA.replace("sf0.001", "sf0.01")
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    found = QUERIES["op13_page_text"](spark, data).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


LONG = "The harbour was rebuilt in the spring, and the first ships came back in May. Nobody had expected it."
UNSEEN = {
    "blog": f"<body><div id='top-bar'><a href='/'>Start</a> <a href='/b'>Books</a></div><div class='blog-content'><h1>Harbour news</h1><p>{LONG}</p>"
    f"<p>{LONG} <a href='x'>Read it</a>.</p></div><div id='comments'><h3>2 comments</h3><p>Nice one! says: bob</p></div><div class='footer-area'>© 2023 Harbour</div></body>",
    "table layout": f"<body><table><tr><td class='nav'><a href='a'>Home</a><br><a href='b'>Prices</a></td><td class='text'><h2>Harbour news</h2><p>{LONG}<p>{LONG}</td></tr></table>"
    "<center><small>Copyright 1999</small></center></body>",
    "main and aside": f"<html><body><header><nav><ul><li><a>Home</a></li></ul></nav></header><main><h1>Harbour news</h1><p>{LONG}</p><ul><li>First point of the list.</li></ul><p>{LONG}</p></main>"
    "<aside><h3>Most read</h3><ul><li><a href=q>Ten ships you must see</a></li></ul></aside><form>Your email address <input></form><footer><p>Impressum</p></footer></body></html>",
    "plain": f"<html><body><h1>Harbour news</h1><p>{LONG}</p><p>{LONG}</p></body></html>",
    "notice": f"<body><div class='cookie-banner'><p>We use cookies to improve your visit.</p></div><article><header><h1>Harbour news</h1></header><p>{LONG}</p>"
    f"<aside class='ad'>Buy boats now</aside><p>{LONG}</p><section class='comments'><p>I was there in May.</p></section></article></body>",
}
WANT = {
    "blog": ["Harbour news", LONG, f"{LONG} Read it."], "table layout": ["Harbour news", LONG, LONG],
    "main and aside": ["Harbour news", LONG, "First point of the list.", LONG], "plain": ["Harbour news", LONG, LONG], "notice": ["Harbour news", LONG, LONG],
}


@pytest.fixture(scope="module")
def model(spark):
    common.prepared(spark)
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    return page_text.learn(pages, F.col("url"))


@pytest.mark.parametrize("name", list(UNSEEN))
def test_unseen_layouts(model, name):
    assert page_text.chosen_texts(model, [blocks(UNSEEN[name])], {})[0].split("\n\n") == WANT[name]


def test_labels_of_composed_pages_not_learned_from(model):
    chance, wrong, total = random.Random(4242), 0, 0
    for _ in range(200):
        page = page_text.composed([["Ships came in. They left again.", "More about ships."]], chance)
        z = model.logits(page_text.encoded([[b for b, _ in page]], {}))
        wrong += int(((z >= 0) != np.array([y for _, y in page])).sum())
        total += len(page)
    assert wrong / total < 0.03


def test_defined_cases(spark, model):
    long = "<body><article>" + f"<p>{LONG}</p>" * 6000 + "</article></body>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<body></body>"), (3, "u", UNSEEN["plain"]), (3, "u", UNSEEN["plain"]), (4, "u", long), (5, "u", "<nav><a>Home</a></nav>")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    found = page_text.extracted(frame, model)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["page_id"], []).append(r["text"])
    assert by_id[1] == by_id[2] == by_id[None] == by_id[5] == [""]
    assert by_id[3] == ["\n\n".join(WANT["plain"])] * 2
    assert by_id[4] == ["\n\n".join([LONG] * 6000)]
    assert page_text.extracted(frame.limit(0), model).count() == 0


def test_without_usable_pages(spark):
    common.prepared(spark)
    frame = spark.createDataFrame([("u", "<p>no mark</p>"), ("v", None)], "url string, html string")
    assert page_text.labelled_pages(frame, F.col("url")) == []
    model = page_text.learn(frame, F.col("url"))
    assert page_text.chosen_texts(model, [blocks(UNSEEN["main and aside"])], {})[0].split("\n\n") == WANT["main and aside"]
