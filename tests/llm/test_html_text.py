from __future__ import annotations

import pytest

from litscope.llm.html_text import extract_text, visible_text

PAGES = [
    ("<p>One<p>Two", "One\n\nTwo"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b  <b>c</b>d", "a\nb cd"),
    ("<head><title>t</title></head><body>x<script>var a='<p>'</script><style>p{}</style>y", "xy"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
    ("<ol start=3><li>a</li><li>b</li></ol>", "3. a\n4. b"),
    ("<table><tr><th>n<th>long head<tr><td>1234<td>x</table>", "n     long head\n1234  x"),
    ("<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>", "wide one  z\na  b  c"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("x<span hidden>no</span><p style='color:red; display : none'>no</p><i style='visibility:hidden'>no</i>y", "xy"),
    ("<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>", "s\ns\nyes"),
    ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
    ("<h1>T</h1>text<p>p</p>", "T\n\ntext\n\np"),
    ("&amp;&eacute;&#x41;&nbsp;x", "&éA\xa0x"),
    ("</p></div>a<b>c", "ac"),
    ("<p>a<div>b</div>", "a\n\nb"),
    ("<blockquote>q</blockquote>r", "  q\n\nr"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("<select><option>a<option>b</select>k<textarea>no</textarea>", "k"),
    ("a<!-- b -->c<hr>d", "ac\n\nd"),
    ("plain", "plain"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_layout(html, text):
    assert visible_text(html) == text


FOREIGN_AND_HEADS = [
    ("<html><head><title>T</title><h1>Hi</h1><p>text", "Hi\n\ntext"),
    ("<head><meta charset=x><title>T</title>plain", "plain"),
    ("<head><noscript><img src=x></noscript><style>p{}</style><link rel=x><p>a", "a"),
    ("<head><title>T</title></html>a", "a"),
    ("<p>a<head><p>b", "a\n\nb"),
    ("<body>a<svg/>b<math/>c", "abc"),
    ("<head><title>t</title><svg width=1 /><body>a", "a"),
    ("a<svg><title>no</title><path d=x /><g>no<text x=1>one</text><text>two <tspan>three</tspan></text></g></svg>b", "a\none\ntwo three\nb"),
    ("<svg><foreignObject><p>a<p>b<b/>c</foreignObject>no</svg>d", "a\n\nbc\nd"),
    ("<svg><defs/><style/><text>a</text></svg>b", "a\nb"),
    ("<svg><path d=x><p>a</p>b", "a\n\nb"),
    ("<svg><text>a<div>b</div>c", "a\nb\nc"),
    ("so <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn><annotation>no</annotation></math> holds", "so x=2 holds"),
    ("<svg hidden><text>no</text></svg>a", "a"),
    ("<svg><desc><p>no</p></desc><text>a</text></svg>", "a"),
]


@pytest.mark.parametrize(("html", "text"), FOREIGN_AND_HEADS)
def test_heads_drawings_and_formulas(html, text):
    assert visible_text(html) == text


def test_deep_and_long_pages():
    assert visible_text("<div>" * 20_000 + "x").strip() == "x"
    assert visible_text("<ul><li>" * 5_000 + "x").endswith("x")
    assert visible_text("<p>word " * 50_000).count("word") == 50_000
    assert "x" in visible_text("<b><i>" * 20_000 + "x")


def test_deep_drawings():
    assert visible_text("<svg><foreignobject>" * 3_000 + "<p>x").strip() == "x"
    assert "x" in visible_text("<svg><g>" * 20_000 + "<text>x")


def test_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "<p>a", "k"), (3, "<p>a", "k"), (None, "<b>z", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    found = extract_text(pages)
    assert found.columns == ["page_id", "text"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, ""), (2, ""), (3, "a"), (3, "a"), (None, "z")], key=repr)
    assert extract_text(pages.limit(0)).count() == 0
