import re
import time
from html.parser import HTMLParser

import pytest

from llm_cases import SF_DIR
from millrace.llm.html import UNSEEN, VOID, extract_text, render
from millrace.session import with_package

CASES = {
    "<p>One<p>Two <b>bo</b>ld  and\n more": "One\n\nTwo bold and more",
    "a<br>b<div>c</div>d": "a\nb\nc\nd",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>t": "- a\n- b\n  3. x\n  4. y\n- c\n\nt",
    "<table><tr><th>name<th>n<tr><td>longer<td>1<tr><td colspan=2>both</table>": "name    n\nlonger  1\nboth",
    "<table><tr><td><p>two</p><p>lines</p><td>b</table>": "two    b\n\nlines",
    "<p hidden>no<p style='display:none'>no<p>yes<script>if (a<b) '</p>'</script><style>p{}</style>": "yes",
    "<head><title>no</title></head><body>yes<template>no</template></body>": "yes",
    "<pre> a\n  b </pre>c": " a\n  b\n\nc",
    "<dl><dt>term<dd>meaning</dl>": "term\n  meaning",
    "&lt;p&gt; &amp;amp; &eacute; &#x1F642;": "<p> &amp; é 🙂",
    "x<!-- <p>no</p> -->y<!doctype html><?php no ?>z": "xyz",
    "</p></div>stray<b>open": "strayopen",
    "<a href=\"x>y\">in</a> <a href='1>out": "in out",
    "<select><option>a<option>b</select>": "a\nb",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>": "a  b\n   c  d",
    "<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h<td>i<td>j</table>":
        "a  b     c\nd        e\nf        g\nh  i  j",
    "<table><tr><td rowspan=2>x<tr><tr><td>y<td>z</table>": "x\ny  z",
    "<table><tr><td><td>b<tr><td>a<td>c</table>": "   b\na  c",
    "<details><summary>more</summary>not this <p>nor this</details>after": "more\nafter",
    "<details open><summary>more</summary>this</details>after": "more\nthis\nafter",
    "<div style='visibility:hidden'>no<p style='visibility: visible'>yes <b>too</b></p>no<br>no</div>end": "yes too\n\nend",
    "<ul><li style='visibility:hidden'>a<li>b</ul>": "- b",
    "": "",
    " \n ": "",
    "< 3 and <3": "< 3 and <3",
}


@pytest.mark.parametrize("html", list(CASES))
def test_rendering(html):
    assert render(html) == CASES[html]


def test_depth_and_length_have_no_limit():
    assert render("<div>" * 20_000 + "deep") == "deep"
    assert render("<p>word" * 20_000).count("word") == 20_000
    assert render("<b c=\"1>d</b>" * 3_000).count("d") == 3_000


def test_tables_stay_in_proportion_to_their_page():
    for page in (
        "<table><tr><td>" + "w" * 20_000 + "<td>x" + "<tr><td>a<td>b" * 2_000,
        "<table><tr>" + "<td rowspan=1000>a" * 900 + "<tr><td>b" * 900,
        "<table>" + "<tr><td colspan=1000>a<td colspan=1000>b" * 1_000,
        "<table>" + "<tr><td rowspan=1000 colspan=1000>a" * 1_000,
    ):
        begun = time.perf_counter()
        text = render(page)
        assert len(text) < 40 * len(page) and time.perf_counter() - begun < 10
        for cell in "ab":
            assert text.count(cell) == sum(part.startswith(cell) for part in page.split(">"))


class _Reader(HTMLParser):
    """A second, plain reading: the words of all that is not in a tag that is not shown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.unseen, self.words = [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        hides = tag in UNSEEN or "hidden" in attrs or "none" in (attrs.get("style") or "") or "visibility" in (attrs.get("style") or "")
        if tag not in VOID and (self.unseen or hides):
            self.unseen.append(tag)

    def handle_endtag(self, tag):
        if tag in self.unseen:
            while self.unseen.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.unseen:
            self.words += data.split()


def test_all_pages_have_the_words_of_a_plain_reading(spark):
    pages = with_package(spark).read.parquet(f"{SF_DIR}/pages.parquet")
    rows = extract_text(pages.select("page_id", "html")).collect()
    assert len(rows) == pages.count()
    for row in rows:
        reader = _Reader()
        reader.feed(row["html"] or "")
        reader.close()
        marks = re.compile(r"^(-|\d+\.)$")
        got = [w for line in row["text"].split("\n") for w in line.split() if not marks.match(w)]
        assert sorted("".join(got)) == sorted("".join(w for w in reader.words if not marks.match(w))), row["page_id"]


def test_column(spark):
    with_package(spark)
    rows = [(1, "<p>a", "old"), (2, None, "old"), (3, "", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = extract_text(pages)
    assert out.columns == pages.columns
    assert [tuple(r) for r in out.orderBy("page_id").collect()] == [(1, "<p>a", "a"), (2, None, ""), (3, "", "")]
    assert extract_text(pages.limit(0)).collect() == []
