import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from roadpulse.llm import htmltext
from tests.conftest import SF001

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                      T.StructField("text", T.StringType())])


def text_of(page, template=frozenset()):
    return htmltext.main_text(htmltext.read_page(page)[1], template)


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{color:red}</style></head><body>
<header class="site"><h1>Site name</h1></header><div id="cookie-notice">We use cookies</div>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="wrap"><div class="sidebar"><p>side</p></div>
<main><article class="post"><header><h1>Head &lt;x&gt; &#233; &amp;amp;</h1></header>
<script>var a = "</p>" + "<article>";</script><p>One <b>bo</b>ld
  two<br>b <a title="x > y" href='#'>link</a> 3 < 4</p><div class="ad-slot">buy</div>
<form><label>q</label><input value="v"><button>Go</button></form><ul><li>i1<li>i2</ul><!-- <p>no</p> -->
<aside>aside</aside><section class="comments"><article class="comment"><p>first!</p></article></section>
</article></main></div><footer>foot</footer></body></html>"""


def test_article_without_its_surroundings():
    assert text_of(ARTICLE) == "Head <x> é &amp; One bold two b link 3 < 4 i1 i2"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<", "<"), ("<p", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("<script>'<p>'", ""),
    ("<div>own text</div><nav>x</nav>", "own text"), ("a&nbsp;b &copy; &#x41", "a b © A"), ("<b>bo</b>ld", "bold"),
    ("<nav><a>x</a><article><p>kept</p></article>", "kept"), ("<article><p>open <b>ended", "open ended"),
    ("</p></div><article>x</article>", "x"), ("<article><p title='>'>t</p></article>", "t"),
    ("<div role=navigation>n</div><p>t</p>", "t"), ("<p hidden>n</p><p>t</p>", "t"), ("<!-- open <p>x", ""),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article><p>" + "long " * 50_000 + "</p></article>", ("long " * 50_000).strip())])
def test_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("element", [
    '<p style="overflow:hidden">', '<p aria-hidden="false">', '<p data-x="a hidden b">', "<p data-hidden=1>",
    '<p title="x id=login">', '<p class="has-sidebar">', '<section id="related-work">', '<h2 id="search-methods">',
    '<h2 id="comments">', '<section id="social-contract">', '<p data-id="nav" data-class=\'menu\' data-role="search">',
    '<p><a href="/hidden-gems">', '<p><a href=/p?id=login>'])
def test_text_that_only_looks_set_apart(element):
    assert text_of(f"<article><p>a</p>{element}kept</article>") == "a kept"
    assert text_of(f"<article {element.split(maxsplit=1)[-1]}kept</article>" if element.startswith("<p ") else
                   f"<main>{element}kept</main>") == "kept"


@pytest.mark.parametrize("element", [
    "<div HIDDEN>", '<div hidden="">', "<div title='x > y' hidden>", '<div class="wide related-posts">',
    "<div class=share-buttons>", "<div id='comments'>", '<div id="cookie-notice">', '<div class="sidebar__inner-2">',
    '<div role="none search">', '<div class="ad-slot ad-300">'])
def test_elements_set_apart(element):
    assert text_of(f"<article><p>kept</p>{element}gone</div></article>") == "kept"


@settings(max_examples=300, deadline=None, database=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class='ad'>", "</div>", "<article>", "</article>",
                                 "<script>", "</script>", "x", " ", "&amp;", "<", ">", "'", '"', "<a href=\"", "<!--",
                                 "-->", "</", "é", "<nav>", "</nav>", "<br/>", "<title>"]), max_size=25))
def test_any_markup_is_read(parts):
    tokens, blocks = htmltext.read_page("".join(parts))
    assert all(b.text == " ".join(b.text.split()) and b.text for b in blocks)
    assert [t for t in tokens if t[1] is not None] == [(b.path, b.text) for b in blocks]


@pytest.mark.parametrize("body, text", [
    ('<p>first part</p><svg class="i"/><p>second part</p>', "first part second part"),
    ('<p>a <svg viewBox="0 0 1 1"><title>Close</title><path d="M0 0"/><circle r=1 /></svg> b</p><p>c</p>', "a b c"),
    ("<p>a</p><svg><path d=x><p>b</p>", "a b"), ("Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be", "Let x=1 be"),
    ("<p>a</p><object data=x><p>in place of it</p></object><p>b</p>", "a in place of it b"),
    ("<p>a</p><select><option>one<option>two<p>b</p>", "a b"), ("<p>a</p><select><option>one</select><p>b</p>", "a b"),
    ('<p class="search">kept</p><p class="related main">too</p><p class="ad">gone</p>', "kept too"),
    ("<p>a</p><section id='reviews'><article><p>liked it</p></article></section>", "a"),
    ("<table><tr><th>k<td>v</table>", "k v")])
def test_elements_inside_an_article(body, text):
    assert text_of(f"<article>{body}</article>") == text
    assert text_of(f"<nav>n</nav><article>{body}</article><footer>f</footer>") == text


def page(i, body, extra=""):
    return f"<html><body><div>Welcome</div><div class=c>{body}<p>By staff</p></div>{extra}<div>Contact us</div></body></html>"


def test_template_classes():
    pages = [page(i, f"<p>Story {i} {'w ' * i}</p>" * (1 + i % 3) + f"<p>end {i}</p>") for i in range(9)]
    read = [htmltext.read_page(p) for p in pages]
    template = htmltext.template_texts([t for t, _ in read])
    assert {t for _, t in template} == {"Welcome", "By staff", "Contact us"}
    assert htmltext.main_text(read[4][1], template) == " ".join(["Story 4 w w w w"] * 2 + ["end 4"])
    # Too few pages are no evidence; a text in no fixed place is none either.
    assert htmltext.template_texts([t for t, _ in read[:5]]) == set()
    moved = [htmltext.read_page(page(i, f"<p>{i}</p>" + ("<p>roams</p><h2>x</h2>" if i % 2 else "<h2>x</h2><p>roams</p>")
                                     ))[0] for i in range(8)]
    assert "roams" not in {t for _, t in htmltext.template_texts(moved)}


def texts_of(spark, pages, **settings):
    """Texts by page_id of the operator on ``pages`` of one host."""
    rows = [(i, f"http://h.example/{i}", p, "x", "y") for i, p in enumerate(pages)]
    return {r.page_id: r.text for r in htmltext.extract_main_text(spark.createDataFrame(rows, PAGES), **settings).collect()}


def test_templates_of_pages_without_article(spark):
    stories = [f"Story {i} {'w ' * i}end".strip() for i in range(9)]
    got = texts_of(spark, [page(i, f"<p>{s}</p>") for i, s in enumerate(stories)])
    assert got == dict(enumerate(stories))


def expected_texts(pages):
    """The template of all different pages of a host at once, without Spark."""
    read = [htmltext.read_page(p) for p in pages]
    first = {}
    for p, (tokens, blocks) in sorted(zip(pages, read), key=lambda x: htmltext._hash(x[0])):
        if common := htmltext._told_apart(blocks):
            first.setdefault(common, tokens)
    template = htmltext.template_texts(list(first.values()))
    return {i: htmltext.main_text(blocks, template) for i, (_, blocks) in enumerate(read)}


def test_template_is_of_the_whole_host(spark):
    """Few different pages among many copies, and more pages than are read
    together, in any order."""
    stories = [f"<p>Story {i} {'w ' * i}</p>" + "<p>by turns</p><i>x</i><div>more</div>" * (i % 3) for i in range(40)]
    pages = [page(i, s, "<div>Most</div>" if i % 3 else "") for i, s in enumerate(stories)]
    pages[4:7] = [page(0, "<p>copy</p>")] * 3
    pages += [pages[9]] * 60
    got = texts_of(spark, pages, chunk=4)
    assert got == expected_texts(pages)
    assert got[0] == "Story 0" and got[4] == "copy" and got[99] == got[9] == "Story 9 " + " ".join("w" * 9)
    turned = texts_of(spark, pages[::-1], chunk=5)
    assert [turned[99 - i] for i in range(100)] == [got[i] for i in range(100)]


@settings(max_examples=6, deadline=None, database=None)
@given(st.lists(st.lists(st.sampled_from(["<p>a</p>", "<p>b</p>", "<h2>c</h2>", "<p class=x>d</p>", "<p>e", "<p>a</p><p>b</p>"]),
                         max_size=8).map("".join), min_size=7, max_size=24))
def test_template_of_any_host(spark, bodies):
    pages = [page(i, f"{b}<p>{i}</p>") for i, b in enumerate(bodies)]
    assert texts_of(spark, pages, chunk=3) == expected_texts(pages)


def test_long_notice_in_short_articles(spark):
    """A template longer than the article goes, on copied pages too; a page
    that has nothing else keeps it."""
    notice = "<p>All views are those of their authors, and none of them is advice on anything at all.</p>"
    pages = [f"<article><h1>Short {i}</h1>{notice}</article>" for i in range(9)]
    pages += [pages[3]] * 4 + [f"<article>{notice}</article>"]
    got = texts_of(spark, pages)
    assert [got[i] for i in range(13)] == [f"Short {i}" for i in [*range(9), 3, 3, 3, 3]]
    assert got[13] == "All views are those of their authors, and none of them is advice on anything at all."


def test_copied_pages_keep_their_article(spark):
    same = "<html><body><article><h1>Copy</h1><p>the same article on every page</p></article></body></html>"
    rows = [(i, "http://h.example/" + str(i), same + " " * i, "x", "y") for i in range(300)]
    got = htmltext.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 300 and {r.text for r in got} == {"Copy the same article on every page"}


def test_edge_rows(spark):
    rows = [(1, "http://a/1", ARTICLE, "x", "y"), (1, "http://a/1", ARTICLE, "x", "y"), (2, None, ARTICLE, "x", "y"),
            (3, "http://a/3", None, "x", "y"), (None, "http://a/4", "", "x", "y"), (5, "not a url", "<p>t", None, None)]
    table = spark.createDataFrame(rows, PAGES)
    got = sorted(((str(r.page_id), str(r.url), r.text, r.n_chars) for r in htmltext.extract_main_text(table).collect()))
    main = text_of(ARTICLE)
    want = [(str(i), str(u), "t" if i == 5 else main if h else "") for i, u, h, _, _ in rows]
    assert got == sorted((*w, len(w[2])) for w in want)
    assert htmltext.extract_main_text(table.limit(0)).count() == 0


def test_real_pages(spark):
    """The driver's pages hold their text in one article element."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    rows = htmltext.op8(spark, SF001).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.split("</article>|<footer", pages[r.page_id].split("<article>", 1)[1])[0]
        inside = re.sub("</?b>", "", re.sub("</?(p|h1|br)[^>]*>", " ", inside))
        assert r.text == " ".join(html.unescape(inside).split()) and r.n_chars == len(r.text)


def test_recurring_headings_of_articles_stay(spark):
    """Recipes of one host: the headings of their parts recur, a notice at the
    end does too."""
    notice = "<p>Views are those of their authors.</p><h3>More recipes</h3>"
    pages = [f"<article><h1>Cake {i}</h1><h2>Ingredients</h2><ul><li>{i} eggs<li>{i * 7} g flour</ul>"
             f"<h2>Method</h2><p>Bake {i} minutes.</p>{notice}</article>" for i in range(8)]
    got = texts_of(spark, pages)
    assert got == {i: f"Cake {i} Ingredients {i} eggs {i * 7} g flour Method Bake {i} minutes." for i in range(8)}


WORDS = st.lists(st.sampled_from(["alpha", "b&c", "é", "3 < 4", "γ", "word", "\"quoted\""]), min_size=1, max_size=6).map(" ".join)
BOILERPLATE = st.sampled_from([
    "<nav><ul><li><a href=/>Home</a></ul></nav>", "<div class='sidebar'><p>side</p></div>", "<!-- <p>no</p> -->",
    "<script>var x = '<p>no</p>';</script>", "<form><label>q</label><select><option>1</select></form>", "<style>p{}</style>",
    "<aside>aside</aside>", "<div role=complementary>c</div>", "<div hidden>h</div>", "<section class=comments><article>no</article></section>",
    "<svg class=i><title>t</title><path d='M0'/></svg>", "<button>Go</button>", "<div class='ad-slot'>buy</div>"])


@settings(max_examples=200, deadline=None, database=None)
@given(st.lists(st.tuples(st.sampled_from(["p", "h2", "li", "blockquote", "div", "pre", "td"]), WORDS, st.lists(BOILERPLATE, max_size=2)),
                max_size=8), st.booleans())
def test_generated_pages(parts, closed):
    """Pages written from known article texts; nothing of the module makes the
    expected text."""
    body, want = [], []
    for tag, words, around in parts:
        piece = f"<{tag}>{html.escape(words)}</{tag}>"
        piece = {"li": f"<ul>{piece}</ul>", "td": f"<table><tr>{piece}</table>"}.get(tag, piece)
        body.append("".join(around) + piece)
        want.append(words)
    whole = (f"<html><head><title>T</title></head><body><header>site</header><main><article>{''.join(body)}"
             + ("</article></main>" if closed else "") + "<footer>foot</footer></body></html>")
    assert text_of(whole) == " ".join(want)


def test_large_hosts_are_split_by_bytes(spark, monkeypatch):
    pages = [page(i, f"<p>Story {i} {'w ' * i}</p>") for i in range(30)]
    whole = texts_of(spark, pages)
    for few in (htmltext.FEW_HOSTS, 0):
        monkeypatch.setattr(htmltext, "FEW_HOSTS", few)
        monkeypatch.setattr(htmltext, "CHUNK_BYTES", 500)
        assert texts_of(spark, pages) == whole
