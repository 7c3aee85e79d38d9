"""Main text against the landmarks of held-out pages, and pages with unusual markup."""

import re
from html import unescape

import pytest

from starloom.llm import extract
from starloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, small):
    return extract.fitted(spark.read.parquet(f"{small}/../sf0.01/pages.parquet"))


def _article(html):
    """Plain reading of the test pages: the paragraphs and heading between the article tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", html, re.S)[1]
    pieces = re.split(r"</?(?:p|h1|h2|h3|div|ul|li|blockquote)\b[^>]*>", re.sub(r"<br\s*/?>", " ", re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", inner, flags=re.S)))
    lines = [" ".join(unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in pieces]
    return "\n".join(x for x in lines if x)


def test_whole_table(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, small).collect()
    assert len(rows) == len(pages)
    assert all(r.n_chars == len(r.text) for r in rows)
    assert sum(r.text == _article(pages[r.page_id]) for r in rows) == len(rows)


def test_held_out_pages(spark, small, model):
    pages = [r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    cut = [extract.blocks_of(h) for h in pages]
    right = [bool(extract.landmark(b)) == p for page, kept in zip(cut, extract.label_pages(cut, model), strict=True) for b, p in zip(page, kept, strict=True)]
    assert sum(right) >= 0.99 * len(right)


def test_blocks():
    html = "<!doctype html><HEAD><title>t</title></head><body class='x y'><script>if (a<b) {}</script><P>One &amp; <b>two<br>three<p>four &nbsp; five<ul><li>a<li>b</ul><div>a < b</div><p>end"
    assert [b.text for b in extract.blocks_of(html)] == ["One & two three", "four five", "a", "b", "a < b", "end"]
    assert extract.blocks_of(html)[0].path == (("body", "x", "y"), ("p",))
    assert extract.blocks_of("") == [] and extract.blocks_of("<p></p><!-- x") == []
    assert [b.text for b in extract.blocks_of("</div></p>text</span>")] == ["text"]


def test_edges(spark, model):
    long = "<article>" + "<p>word word</p>" * 5000 + "</article>"
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", "no tags at all", 5), (4, "u", long, 5), (4, "u", long, 5), (None, "u", "<nav><li>x</nav>", 5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    found = extract.main_text(df, model).collect()
    assert sorted((str(r.page_id), r.text == "") for r in found)[:2] == [("1", True), ("2", True)]
    assert len(found) == 6 and len({r.text for r in found if r.page_id == 4}) == 1
    assert extract.main_text(df.limit(0), model).count() == 0


def test_untrained():
    weights = extract.train([])
    assert len(extract.label_pages([extract.blocks_of("<p>a</p>")], weights)[0]) == 1


def test_unclosed_elements_end():
    def texts(html):
        return [b.text for b in extract.blocks_of(html)]

    assert texts("<html><head><meta charset=x><title>t</title><style>a<b</style><article><p>one<p>two</article>") == ["one", "two"]
    assert texts("<head><link href=x>\n<p>one") == ["one"] and texts("<head><script>x</script>plain") == ["plain"]
    for name in "button select svg object video audio canvas noscript template iframe".split():
        assert texts(f"<article><p>one</p><div><{name}></div><p>two</p></article><p>three")[-2:] == ["two", "three"]
        assert texts(f"<p>one <{name}>x</{name}> two") == ["one two"]
    assert texts("<article><p>one<button></p><p>two</p></article><button>x</button>") == ["one", "two"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so x=2 holds"]
    assert texts("<p>a<script>b<p>c") == ["a"]
