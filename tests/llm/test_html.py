import time

import pytest

from weftwork.llm import html as H

CASES = {
    "blocks": ("<p>One<p>Two &amp; <b>bold<br>line<div>a</div><div>b</div>", "One\n\nTwo & bold\nline\n\na\nb"),
    "space": ("<div> a \n\t b <i> c</i>d </div>", "a b cd"),
    "pre": ("<pre>a\n  b\n\nc</pre>", "a\n  b\n\nc"),
    "list": ("<ul><li>a<li>b<ul><li>c</ul><li><p>d<p>e</ul>", "- a\n- b\n  - c\n- d\n\n  e"),
    "numbers": ("<ol start=9><li>a<li>b<li value=3>c<li>d</ol>", "9. a\n10. b\n3. c\n4. d"),
    "table": ("<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>fig<td>7</table>", "Name   Qty\napple  10\nfig    7"),
    "no rows": ("<table><td>a<td>b</table>", "a  b"),
    "spans": (
        "<table><tr><td rowspan=2>x<td>one<td>1<tr><td>three<td>3<tr><td colspan=2>wide<td>9</table>",
        "x  one    1\n   three  3\nwide      9",
    ),
    "cell lines": ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
    "nested table": ("<table><tr><td><table><tr><td>1<td>2</table><td>z</table>", "1  2  z"),
    "hidden": (
        "<p hidden>n<p style='color:red; DISPLAY : none !important'>n<p style='visibility:hidden'>n<span style='visibility:visible'>y</span>n",
        "y",
    ),
    "head": ("<head><title>n</title><style>p{}</style></head><body><script>if(a<b)'</p>'</script>y", "y"),
    "no head end": ("<head><meta charset=x><p>y", "y"),
    "details": ("<details><summary>s</summary>n</details><details open><summary>t</summary>y</details><dialog>n</dialog>", "s\nt\ny"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "comments": ("a<!-- <p>n -->b<!-->c<!DOCTYPE x>d<?php n ?>e", "abcde"),
    "open comment": ("a<!-- n <p>n", "a"),
    "broken tag": ("a<p class='x", "a"),
    "angles": ("1 < 2 and 3 > 2 <3", "1 < 2 and 3 > 2 <3"),
    "quotes": ("<a title='>' href=\"a>b\">y</a>", "y"),
    "entities": ("&lt;p&gt; &#233; &nbsp;x &unknown;", "<p> é  x &unknown;"),
    "stray ends": ("</p></b>a</div></td>b", "ab"),
    "hidden body": ("<body hidden>n", ""),
    "rule": ("a<hr>b", "a\n\nb"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    page, want = CASES[name]
    assert H.visible_text(page) == want


def test_odd_pages_take_linear_time_and_keep_text():
    for piece in ("<", "<a", "<a '", "<!--", "<table>", "<ul><li>", "</p>", "<p>", "&", "<td>", "<script>"):
        start = time.time()
        H.visible_text(piece * 30_000 + ">")
        assert time.time() - start < 8, piece
    assert H.visible_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "end").split() == ["deep", "end"]
    assert H.visible_text("word " * 200_000).count("word") == 200_000


def test_table_of_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (None, "b\0c")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, text string")
    got = sorted(((r["page_id"] or 0, r["text"]) for r in H.extract_text(pages).collect()))
    assert got == [(0, "bc"), (1, ""), (2, ""), (3, "a"), (3, "a")]
    assert H.extract_text(pages.filter("false")).collect() == []


def test_given_pages_keep_all_shown_words(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.join(H.extract_text(pages), "page_id").collect():
        assert "track(" not in r["text"] and "{margin" not in r["text"] and "<p>" not in r["text"]
        assert r["text"].startswith("- ") and "©" in r["text"]


def test_deep_nesting_and_wide_spans_keep_their_layout():
    deep = "<ul><li>" * 250 + "end" + "</li></ul>" * 250  # 500 elements
    assert H.visible_text(deep) == "- " * 250 + "end"
    page = "<table><tr><td colspan=500>a</td><td>z</td></tr><tr>" + "<td>b</td>" * 500 + "<td>y</td></tr></table>"
    first, second = H.visible_text(page).split("\n")
    assert first.index("z") == second.index("y") == 1500
    tall = "<table><tr><td rowspan=400>a</td><td>0</td></tr>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(1, 400)) + "</table>"
    assert [line.index(str(i)) for i, line in enumerate(H.visible_text(tall).split("\n"))] == [3] * 400
    assert "text" in H.visible_text("<div>" * 5000 + "text")
