from __future__ import annotations

import time

import pytest
from helpers import with_extras

from skyledger.llm import html_layout
from skyledger.llm.html_layout import rendered

PAGES = [
    ("<p>One <b>two</b>three<p>Four<br>five &amp; six", "One twothree\n\nFour\nfive & six"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "* a\n* b\n  - c\n* d"),
    ("<ol start=9><li>x<li value=20>y<li>z</ol>", "9. x\n20. y\n21. z"),
    ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
    ("<table><tr><th>Name<th>N<tr><td>long one<td>1<tr><td>b<td>22</table>", "Name      N\nlong one  1\nb         22"),
    ("<table><tr><td rowspan=2>r<td>a<tr><td>b</table>", "r  a\n   b"),
    ("<table><tr><td>a<td>b<tr><td colspan=2>one wide cell<tr><td>c<td>d</table>", "a  b\none wide cell\nc  d"),
    ("<table><tfoot><tr><td>foot</tfoot><tbody><tr><td>body</table>", "body\nfoot"),
    ("<table><tr><td>x<br>y<td>z</table>after", "x  z\ny\n\nafter"),
    ("<pre>\n a  b\n\n  c</pre>", " a  b\n\n  c"),
    ("<div>a</div><div>b</div>c<section>d</section>", "a\nb\nc\nd"),
    ("<h1>T</h1>text<blockquote>q<p>r</blockquote>", "T\n\ntext\n\n    q\n\n    r"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n    d1\n    d2"),
    ("a<script>var t='</p>'</script>b<style>p{}</style>c<!-- x -->d<template>e</template>", "abcd"),
    ("<head><title>T</title></head><body>b", "b"),
    ("<p hidden>h<p>s<span style='display: none'>n</span><i style='visibility:hidden'>v<b style='visibility:visible'>w</b></i>", "sw"),
    ("<style>.x, #y {display:none} p{margin:0}</style><p class='a x'>1<p id=y>2<p>3", "3"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<b><p>mis</b>nested</p> x < y &lt; z</b>", "misnested\n\nx < y < z"),
    ("a  b\n\tc&nbsp;&nbsp;d", "a b c  d"),
    ("<a title='x>y' href=\"b\">link</a> <img alt=no><input type=submit value=Go><input type=hidden value=no>", "link Go"),
    ("<textarea>a <b>\n c</textarea>", "a <b>\n c"),
    ("<p>a</p></p><p>b</div></table></li>c", "a\n\nbc"),
    ("<a title='unclosed>text", "text"),
    ("<!-- never closed <p>x", ""),
    ("<select><option>o<option>p</select>", "o\np"),
    ("<noscript>shown</noscript><iframe>not</iframe><p/>x", "shown\n\nx"),
]


QUOTES = [
    ("<p title=it's>Seen</p><p>it's more</p>", "Seen\n\nit's more"),
    ("<p title='a'b'>One</p><p>it's two", "One\n\nit's two"),
    ("<a href=/x?q=\"a>link</a> say \"b\"", 'link say "b"'),
    ("<p 'a>One</p><p>it's two", "One\n\nit's two"),
    ("<p a = 'x>y' b=\"it's>\"c='>'>One", "One"),
    ("<p title='x=y>' b==' c>One</p>'", "One\n\n'"),
    ("</p title=it's>One</b>'", "One'"),
]


@pytest.mark.parametrize("html, text", QUOTES)
def test_quotes_in_tags(html, text):
    assert rendered(html) == text


STYLED = [
    ("@media print{.a{display:none}}", "<p class=a>s", "s"),
    ("@media (max-width:600px){.a{display:none}}", "<p class=a>s", "s"),
    ("@media screen and (max-width: 40em), print{.a{display:none}}", "<p class=a>s", "s"),
    ("@media (width < 600px) or (prefers-color-scheme: dark){.a{display:none}}", "<p class=a>s", "s"),
    ("@media not screen{.a{display:none}}", "<p class=a>s", "s"),
    ("@media screen and (min-width:600px){.a{display:none}} .b{margin:0}", "<p class=a>h<p>s", "s"),
    ("@media not print{.a{display:none}}", "<p class=a>h<p>s", "s"),
    ("@media (400px <= width <= 2000px){.a{display:none}}", "<p class=a>h<p>s", "s"),
    (".a{display:none} @media (min-width:768px){.md\\:block{display:block}}", "<p class='a md:block'>s", "s"),
    ("@media print{.a{color:red} @media all{.b{display:none}}} .c{display:none}", "<p class=a>s<p class=b>t<p class=c>h", "s\n\nt"),
    ("@supports not (display:grid){.a{display:none}}", "<p class=a>s", "s"),
    ("@keyframes k{from{visibility:hidden}to{visibility:visible}} p{color:red}", "<p>s", "s"),
    (".a{display:none} .a{display:block}", "<p class=a>s", "s"),
    (".a{display:block} .a{display:none}", "<p class=a>h", ""),
    ("#i{display:block} .a{display:none}", "<p class=a id=i>s", "s"),
    (".a{display:none!important} .a{display:block}", "<p class=a style='display:block'>h", ""),
    (".a{display:none}", "<p class=a style='display:block'>s", "s"),
    (".a{display:none}", "<p class=a style='color:red'>h", ""),
    (".a{display:none} .n .a{display:block}", "<p class=a>h<div class=n><p class=a>s", "s"),
    (".a{display:none} .n:hover .a{display:block}", "<div class=n><p class=a>h", ""),
    (".a{display:none} #t:checked ~ .a{display:block}", "<input type=checkbox id=t checked><i>x</i><p class=a>s", "x\n\ns"),
    ("li:nth-child(2n){display:none} li:not(.k){visibility:hidden}", "<ul><li class=k>a<li class=k>b<li class=k>c</ul>", "* a\n* c"),
    (".a{visibility:hidden} b{visibility:visible}", "<p class=a>h<b>s</b>", "s"),
    (".a{visibility:hidden}.a{visibility:visible}", "<p class=a>s", "s"),
    (".a{content:'}.b{display:none}'} /* .b{display:none} */ .c{display:inline}", "<p class=b>s", "s"),
    (".a{display:none; .b &{display:block}}", "<p class=a>h<div class=b><p class=a>s", "s"),
    (".a{display:hide} .a::before{display:none}", "<p class=a>s", "s"),
    ("@layer x{.a{display:none}} @layer y{#i{display:none}} p{display:block}", "<p class=a id=i>s", "s"),
    ("p{display:block}", "<p hidden>s", "s"),
]


@pytest.mark.parametrize("sheet, html, text", STYLED)
def test_styles_on_a_screen(sheet, html, text):
    assert rendered(f"<style>{sheet}</style>{html}") == text


def test_sheets_of_other_media():
    assert rendered("<style media=print>p{display:none}</style><p>s") == "s"
    assert rendered("x<template><style>p{display:none}</style></template><p>s") == "x\n\ns"
    assert rendered("<style media='screen, print'>p{display:none}</style><p>h") == ""
    # of two sheets the later one decides
    assert rendered("<style>p{display:none}</style><style>p{display:block}</style><p>s") == "s"


def test_long_sheets():
    many = "".join(f".n .c{i}{{display:none}}" for i in range(5000))
    assert rendered(f"<style>{many}</style><div class=n>" + "<p class=x>s" * 5000).split() == ["s"] * 5000
    assert rendered("<style>" + "@media all{" * 20_000 + "p{display:none}</style><p>s") == ""  # however deep, the rule counts
    assert rendered("<style>" + "a " * 20_000 + "{display:none}</style><p>s") == "s"
    assert rendered("<style>li ~ li{display:none}</style>" + "<li>s" * 20_000) == "s"
    assert rendered("<style>" + "{" * 50_000 + ":not(" * 50_000 + "display:none</style><p>s") == "s"


@pytest.mark.parametrize("html, text", PAGES)
def test_layout(html, text):
    assert rendered(html) == text


def test_all_text_of_deep_and_long_pages():
    deep = "<div>" * 3000 + "end" + "<table><tr><td>" * 300 + "cell"
    assert rendered(deep).split() == ["end", "cell"]
    long = "<p>word " * 20_000
    assert rendered(long).split() == ["word"] * 20_000
    assert rendered("x" + "<b " * 200_000) == "x"
    assert rendered("x" + '<a "' * 100_001 + ">y").endswith("y")
    assert rendered("x < 3" + "</p" * 200_000).startswith("x < 3")


def test_rows(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<p>x", None), (3, "<p>x", None), (None, "y", None)]
    pages = with_extras(spark.createDataFrame(rows, "page_id long, html string, url string"), "text", "tag")
    got = [tuple(r) for r in html_layout.extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (2, ""), (3, "x"), (3, "x"), (None, "y")], key=str)
    assert html_layout.extract(pages.where("false")).collect() == []


def test_depth_hides_nothing_and_shows_nothing():
    for n, tag in ((220, "div"), (3000, "div"), (198, "span"), (2500, "span"), (700, "b")):
        for hide in ("hidden", "style='display:none'"):
            page = f"<{tag}>" * n + f"<div {hide}><p>SECRET</p><{tag}>SECRET</{tag}></div>seen" + f"</{tag}>" * n + "<p>after</p>"
            assert rendered(page).split() == ["seen", "after"], (n, tag, hide)
    assert rendered("<ul><li>" * 300 + "x").split()[-1] == "x"
    assert rendered("<table><tr><td>" * 150 + "x" + "</table>" * 150).strip() == "x"


def test_many_ends_of_what_is_not_open_take_no_time():
    began = time.perf_counter()
    page = "<span>" * 20_000 + "</i></p><div></div>" * 20_000 + "x"
    assert rendered(page).split() == ["x"]
    assert time.perf_counter() - began < 20


def test_deep_and_long_rules_count():
    nested = "@media all{" * 60 + ".a{display:none}" + "}" * 60
    assert rendered(f"<style>{nested}</style><p class=a>SECRET</p><p>seen</p>") == "seen"
    chain = " ".join(["div"] * 119) + " .a"
    page = f"<style>{chain}{{display:none}}</style>" + "<div>" * 119 + "<p class=a>SECRET</p><p>seen</p>"
    assert rendered(page) == "seen"
    inner = ":is(" * 40 + ".a" + ")" * 40
    assert rendered(f"<style>{inner}{{display:none}}</style><p class=a>SECRET</p><p>seen</p>") == "seen"


def test_numbers_of_lists():
    for start, first in (("12345678901", "1."), ("2147483647", "2147483647."), ("-3", "-3."), ("007", "7."), ("x", "1.")):
        assert rendered(f"<ol start={start}><li>a</ol>").split()[0] == first
