import time
from collections import Counter
from html.parser import HTMLParser

import pytest
from vantage.llm.html import extract_text, page_text

CASES = {
    "": "",
    "plain &amp; simple": "plain & simple",
    "<p>a<p>b": "a\n\nb",
    "<div>a</div><div>b</div>": "a\nb",
    "<p>one <b>two</b>three</p>": "one twothree",
    "<ul><li>x<li>y<ul><li>z</ul></ul>": "- x\n- y\n  - z",
    "<ol start=3><li>x</li><li>y</li></ol>": "3. x\n4. y",
    "<script>var a = '<p>no</p>';</script>yes": "yes",
    "<div hidden>no</div><p style='display: none'>no<p>yes": "yes",
    "<span aria-hidden=true>no</span>yes": "yes",
    "<table><tr><th>name<th>q<tr><td>apple<td>10<tr><td>fig<td>2</table>": "name   q\napple  10\nfig    2",
    "<table><caption>t</caption><tr><td colspan=2>ab<td>c</table>": "t\nab    c",
    "<pre>a\n  b</pre>": "a\n  b",
    "a<br>b<br/>c": "a\nb\nc",
    "<!-- no -->yes<!-- open": "yes",
    "<textarea>a &amp; b": "a & b",
    "<b>un<i>closed</b> x": "unclosed x",
    "<title>no</title><h1>yes</h1>text": "yes\n\ntext",
    "a < b and <c": "a < b and",
    "<img alt='pic'>": "pic",
}


@pytest.mark.parametrize("source", list(CASES))
def test_layout(source):
    assert page_text(source)[0] == CASES[source]


WHOLE = {
    "<table><td>a<td>b</table>": "a  b",
    "<table><tbody><td>a<tr><td>b</table>": "a\nb",
    "<table>stray<tr>more<td>a</table>z": "straymore\n\na\n\nz",
    "<table><form><tr><td>a</form><td>b</table>": "a  b",
    "<table><center>c</center><tr><div>d</div><td>a</table>": "c\nd\n\na",
    "<table hidden>out<tr><td>in</table>": "out",
    "<table><tr><td>a<table><tr><td>b</table>c</table>d": "a b c\n\nd",
    "<table><template><tr><td>no</template><tr><td>a</table>": "a",
    "<head><title>no</title><meta x><p>yes": "yes",
    "<head><style>no</style>\n yes": "yes",
    "<head><noscript><img alt=no></noscript><link x></head>yes": "yes",
    "<pre><code>a\n  <b>b</b>\n\tc</code></pre>": "a\n  b\n\tc",
    "<pre>a<br>  b<div>c</div>d</pre>": "a\n  b\nc\nd",
    "<xmp>a <b>\n  c</xmp>": "a <b>\n  c",
    "<i>" * 200 + "<span hidden>no</span>yes": "yes",
    "<div hidden>" + "<div>" * 200 + "no" + "</div>" * 200 + "no</div>yes": "yes",
    "<i>" * 125 + "<table><tr><td>a<td>b</table>c": "a  b\n\nc",
    "<i>" * 200 + "<table>s<td>a</table>c": "s\n\na\n\nc",
    "<div>" * 300 + "<ul><li>a<li>b</ul>": "- a\n- b",
    "<button>Buy <b>now</b></button>": "Buy now",
    "<dialog>no</dialog><dialog open>yes</dialog>": "yes",
    "<select><option>a<option selected>b</select><select><option>c<option>d</select>": "bc",
    "<select multiple><option>a<option>b</select>": "a b",
    "<input value=name> <input type=submit value=Go><input type=hidden value=no>": "name Go",
    "<p style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no": "yes",
    "<div style='display:none'><b style='visibility:visible'>no</b></div>yes": "yes",
    "<table><tr><td rowspan=2>A<td>b<tr><td>c</table>": "A  b\n   c",
    "<table><tr><td colspan=2 rowspan=2>A<td>b<tr><td>c<tr><td>d<td>e<td>f</table>": "A     b\n      c\nd  e  f",
    "<ol><li value=5>a<li>b</ol>": "5. a\n6. b",
    "<ol start=-1><li>a<li>b</ol>": "-1. a\n0. b",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
}


@pytest.mark.parametrize("source", list(WHOLE))
def test_no_visible_text_is_lost(source):
    assert page_text(source)[0] == WHOLE[source]


def test_deep_markup_stays_linear():
    t = time.time()
    for s in ("<p><button>" + "<div>" * 50_000 + "x", "<table>" + "<b>x" * 50_000, "<table><tr><td>" * 20_000 + "x", "<ul><li>" * 30_000 + "x",
              "<div>" * 50_000 + "x</div>" * 50_000, "<select><option>" * 20_000 + "x", "<details open>" * 30_000 + "x", "<pre><div>" * 20_000 + "x"):
        assert "x" in page_text(s)[0]
    assert time.time() - t < 30


def test_hostile_markup_stays_linear():
    t = time.time()
    for s in ("<div>" * 50_000 + "x", "<p>" * 50_000, "<a " * 50_000, '<a b="' * 30_000, "<" * 100_000, "&" * 100_000, "<li>" * 50_000):
        page_text(s)
    assert time.time() - t < 30


class Words(HTMLParser):
    """Slow independent reader: all words outside of elements that never show."""

    GONE = {"head", "script", "style", "template", "noscript", "iframe", "title", "svg", "video", "audio", "object"}

    def __init__(self):
        super().__init__()
        self.open, self.words = [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        gone = tag in self.GONE or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", "")
        if tag == "img":
            self.words += [] if any(g for _, g in self.open) or gone else (a.get("alt") or "").split()
        if tag not in ("img", "br", "hr", "meta", "link", "input", "wbr"):
            self.open.append((tag, gone))

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(g for _, g in self.open):
            self.words += data.split()


def test_words_of_the_given_pages(spark, sf):
    """Letters of each page as a slow reader sees them, layout marks (bullets, numbers, rules) aside."""
    def letters(s):
        return Counter(c for c in s if c.isalpha())
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        slow = Words()
        slow.feed(r["html"])
        slow.close()
        assert letters(page_text(r["html"])[0]) == letters(" ".join(slow.words)), r["page_id"]


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in extract_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        text = got[r["page_id"]]["text"]
        assert "<" not in text and "track(" not in text and text
    rows = [(1, None, "u", 3), (2, "", "u", 3), (3, "<p>x", "u", 3), (3, "<p>x", "u", 3), (None, "y", "u", 3)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, n_blocks int")
    assert sorted((str(r["page_id"]), r["text"], r["n_blocks"]) for r in extract_text(df).collect()) == sorted(
        [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("3", "x", 1), ("None", "y", 1)])
    assert extract_text(df.limit(0)).count() == 0
