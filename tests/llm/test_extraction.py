import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import extraction, queries
from ledgerline.llm.labelled_pages import labelled_pages

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def field():
    return extraction.trained()


def test_held_out_labelled_pages(field):
    wrong = total = 0
    for page in labelled_pages(200, seed=77):
        held = extraction.blocks(page)
        for block, label in zip(held, field.labels(held), strict=True):
            total += 1
            wrong += (block.label == "main") != bool(label)
    assert total > 3000 and wrong / total < 0.01


def test_viterbi_and_expectations_against_all_paths(field):
    for page in labelled_pages(40, seed=8):
        held = extraction.blocks(page)[:9]
        paths = [extraction.path_of(block) for block in held]
        rows = [extraction.path_features(p) + extraction.text_features(held, paths, i) for i, p in enumerate(paths)]
        scores = [sum(field.weights[field.places[f]] for f in set(r) if f in field.places) for r in rows]
        weight = {}
        for labels in itertools.product((0, 1), repeat=len(held)):
            weight[labels] = sum(s for s, y in zip(scores, labels, strict=True) if y)
            weight[labels] += sum(field.steps[a, b] for a, b in itertools.pairwise(labels))
        best = max(weight, key=weight.get)
        assert weight[tuple(field.labels(held))] == pytest.approx(weight[best])
        chances, pairs = field._expected(scores)
        whole = sum(math.exp(w) for w in weight.values())
        for i, chance in enumerate(chances):
            assert chance == pytest.approx(sum(math.exp(w) for y, w in weight.items() if y[i]) / whole)
        want = np.zeros((2, 2))
        for labels, w in weight.items():
            for a, b in itertools.pairwise(labels):
                want[a, b] += math.exp(w) / whole
        assert pairs == pytest.approx(want)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h2>Site</h2><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies, please accept them all.</p><button>OK</button></div>
<article><h1>A  title &amp;&#160;more</h1><p>First paragraph of
 the <b>text</b>, long enough to read.<p>Second &lt;one&gt;, with a<br>break and more words.
<script>var x = "</p><p>no";</script><!-- <p>hidden</p> -->
<div class="ad">Buy this thing now</div>
<blockquote>A quoted sentence that belongs to the article.</blockquote>
<section class="comments"><div class="comment"><p>I like this article very much, thank you.</p></div></section>
</article><aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>Other story</a></li></ul></aside>
<form><label>Name</label><input><textarea>x</textarea><button>Send</button></form>
<footer><p>&copy; 2024 Someone. All rights reserved.</p></footer></body></html>"""

TEXT = """A title & more
First paragraph of the text, long enough to read.
Second <one>, with a break and more words.
A quoted sentence that belongs to the article."""


def test_a_page_with_everything(field):
    assert field.text(PAGE) == TEXT


def test_broken_markup_and_edges(spark, field):
    pages = [None, "", "   ", "plain text", "<p", "<<<>>>", "<p>a<b", "</p></div>", '<p title="x>y</p>', "<script>never ends",
             "<article>" + "<p>word word word.</p>" * 20_000 + "</article>", PAGE, PAGE]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("text", F.lit("clash"))
    out = {r.page_id: r.got for r in df.withColumn("got", extraction.main_text(F.col("html"), field)).collect()}
    assert out[0] == out[1] == out[2] == ""
    assert out[10].count("\n") >= 19_990
    assert out[11] == out[12] == TEXT


def read(page):
    return [block.text for block in extraction.blocks(page)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><body><article><p>Main text</p></article></body></html>", ["Main text"]),
        ("<head><meta charset=u><title>t<body><p>Main text</p>", ["Main text"]),
        ("<head><title>t</title><link href=x><p>One</p><p>Two</p>", ["One", "Two"]),
        ("<head><noscript><style>p{}</style></head><body><p>One</p><noscript>no</noscript>", ["One"]),
        ('<p>Before <svg class="icon"/> after.</p><p>Next</p>', ["Before after.", "Next"]),
        ("<p>Before <svg><title>t</title><path/><text>no</text></svg> after.</p>", ["Before after."]),
        ("<p>Before <svg><svg/><svg><g></g></svg>no</svg> after.</p>", ["Before after."]),
        ("<svg><foreignObject><div>no</div></foreignObject>no</svg><p>One</p>", ["One"]),
        ("<p><svg><path></p><p>One</p><svg></svg>", ["One"]),
        ("<article><div><svg><g></div><p>One</p></article><svg></svg>", ["One"]),
        ("<svg-icon name=x></svg-icon><head-line>One</head-line>", ["One"]),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p><p>Two</p>", ["Let x=2 be.", "Two"]),
        ("<p>Empty <math/> one.</p><p>Two</p>", ["Empty one.", "Two"]),
        ("<p>Open <math><mi>x<p>Two</p><div>Three</div>", ["Open x", "Two", "Three"]),
        ("<p>A <object data=x><param name=a>fallback</object> text.", ["A fallback text."]),
        ("<p>A <object data=x>fallback</object> text.", ["A fallback text."]),
        ("<article><select><option>no</select><p>One</p><select><option>no<p>Two</p></article><p>Three", ["One", "no", "Two", "Three"]),
        ("<template><template>no</template>no</template><p>One", ["One"]),
        ("<p>One <template>two", ["One two"]),
    ],
)
def test_unclosed_and_unseen_elements_hide_nothing_else(page, want):
    assert read(page) == want


@pytest.mark.parametrize("name", ["sidebar", "comments", "cookie-notice"])
def test_a_telling_name_behind_many_others(field, name):
    many = "w-full max-w-screen-lg mx-auto flex flex-col items-center justify-between"
    prose = "<p>A paragraph of the article, which is long enough to be read as such by any reader of it.</p>" * 3
    page = f'<article><h1>A title of it</h1>{prose}<div class="{many} {name}"><p>A sentence that is no part of it, as its name tells.</p></div>{prose}</article>'
    names = extraction.blocks(page)[4].path[1][1]
    assert set(name.split("-")) <= set(names) and len(names) == len(set(names))
    assert field.text(page) == field.text(page.replace(many, ""))
    if name == "cookie-notice":
        assert "no part" not in field.text(page) and field.text(page).count("\n") == 6


def test_query(spark):
    out = queries.QUERIES["op10_main_text"](spark, DATA)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    given = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    field = extraction.trained()
    rows = out.collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r.n_chars == len(r.text) and r.text == field.text(given[r.page_id])
        if given[r.page_id]:
            assert "Subscribe" not in r.text and "<" not in r.text.replace("&lt;", "")


@pytest.mark.parametrize("bit", ["<x ", '<a href="', '<a ">" ', "<title>", "<title></title x", "<script></script ", "<p \"'", "<a"])
@pytest.mark.parametrize("tail", ["", ">", '">'])
def test_tags_that_never_close_take_linear_time(bit, tail):
    start = time.perf_counter()
    extraction.blocks(bit * (1_000_000 // len(bit)) + tail)
    assert time.perf_counter() - start < 30


def test_ends_of_odd_tags():
    def texts(page):
        return [block.text for block in extraction.blocks(page)]

    assert texts('<p title="a > b">one</p>two') == ["one", "two"]
    assert texts('<p title="a>one</p>two') == ["one", "two"]
    assert texts("<p>one <b two") == ["one <b two"]
    assert texts("<p>one</p><script>x</script y") == ["one"]
    assert texts("<title>a</title x><p>one") == ["one"]
