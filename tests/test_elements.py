"""Elements of pages: nested, unclosed and stray tags."""

from __future__ import annotations

import pytest

from pitfeat.sources.pages import MATCH_CELL, cut, elements, extract_listing, extract_match_stats

CASES = [
    ("<p>a</p><p>b</p>", "p", ["a", "b"]),
    ("<p>a<p>b</p>c</p>d", "p", ["a<p>b</p>c", "b"]),  # nested
    ("<p>a<p>b", "p", ["a<p>b", "b"]),  # open to the end
    ("<div><p>a</div>b<p>c</p>", "p", ["a", "c"]),  # closed with its parent
    ("<tr><td><table><tr>x</tr></table></td>y</tr>z", "tr", ["<td><table><tr>x</tr></table></td>y", "x"]),
    ("</p>a<p>b</p></p>", "p", ["b"]),  # stray end tags
    ("<p>a<br>b<img src='x'>c</p>", "p", ["a<br>b<img src='x'>c"]),  # elements without an end
    ("<p>a<!-- </p> <p> -->b</p>", "p", ["a<!-- </p> <p> -->b"]),
    ("<p>a<script>if (x < y) '</p>'</script>b</p>", "p", ["a<script>if (x < y) '</p>'</script>b"]),
    ("<P Class=x>a</P >", "p", ["a"]),
    ("<p title='a > b'>c</p>", "p", ["c"]),
    ("<p title=it's>c</p>", "p", ["c"]),
    ("<pre>a</pre><p>b</p>", "p", ["b"]),  # not a longer name
    ("a < b <p>c</p> d <", "p", ["c"]),
    ("<p/>a<p>b</p>", "p", ["a<p>b</p>", "b"]),
    ("<!-- <p>a</p>", "p", []),
    ("", "p", []),
]


@pytest.mark.parametrize("html, tag, want", CASES)
def test_elements(html, tag, want):
    assert cut(html, [(tag, None)]) == [want]


def test_classes_and_several_at_once():
    html = "<p class='a b'>1</p><p class=\"b\">2</p><p class=a>3</p><p data-class='a'>4</p><p>5</p><i class='a'>6</i>"
    assert cut(html, [("p", "a"), ("p", "b"), ("p", None), ("i", "a")]) == [["1", "3"], ["1", "2"], ["1", "2", "3", "4", "5"], ["6"]]


def test_long_page_is_one_pass():
    deep = "<p>" * 20000 + "x"
    assert [len(e) for e in cut(deep, [("b", None), ("p", "c")])] == [0, 0]
    assert cut("<" * 200000, [("p", None)]) == [[]]


def test_null_pages(spark):
    pages = spark.createDataFrame([(1, None), (2, "<p>a<p>b</p></p>")], "k int, html string")
    got = {r.k: r.e for r in pages.select("k", elements(pages.html, ("p", None)).alias("e")).collect()}
    assert got == {1: [[]], 2: [["a<p>b</p>", "b"]]}


def test_nested_tables_in_listing_and_match(spark):
    row = "b-statistics__table-row"
    inner = "<table><tr><td>note</td></tr></table>"
    html = f"<table><tr class='{row}'><td>{inner}<a href='http://x/1'>One</a><span>May 3, 2020</span></td></tr><tr class='{row}'><td><a href='http://x/2'>Two</a> <span>June 4, 2021</span></table>"
    pages = spark.createDataFrame([("l", html)], "page_id string, html string")
    got = [(r.event_url, r.event_date, r.title) for r in extract_listing(pages).orderBy("position").collect()]
    assert got == [("http://x/1", "2020-05-03", "One"), ("http://x/2", "2021-06-04", "Two")]
    cells = "".join(f"<p class='{MATCH_CELL[1]}'><p>{k}</p></p>" for k in range(20))
    match = spark.createDataFrame([("http://m/", cells)], "url string, html string")
    got = {r.side: (r.knockdowns, r.submission_att, r.ctrl_time) for r in extract_match_stats(match).collect()}
    assert got == {0: ("2", "14", "18"), 1: ("3", "15", "19")}
