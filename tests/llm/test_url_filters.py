from __future__ import annotations

import html.parser
import random

from helpers import with_extras
from pyspark.sql import functions as F

from skyledger.llm import components, url_filters

RULES = [("allow", "com/"), ("block", "bad.com/x/"), ("allow", "ok.bad.com/x/"), ("block", "net/es/"), ("block", "evil.org/")]


def canonical(url):
    return f"<html><head><LINK href='{url}' rel=canonical></head></html>".replace("<LINK href='", "<link rel='canonical' href='")


def judged(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = with_extras(pages, "host", "node", "verdict", "rule")
    found = url_filters.judge(pages, url_filters.rule_table(spark, RULES), **options)
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r))


def test_rules_hosts_and_paths(spark):
    rows = [
        (1, "http://WWW.Bad.COM/x/Page?q=1#top", None),
        (2, "https://a.ok.bad.com/x/1", ""),
        (3, "http://bad.com/y", None),
        (4, "http://bad.com", None),
        (5, None, "<html>"),
        (6, "no scheme/bad.com/x/", None),
        (7, "http://site.net/es/1", None),
        (8, "http://notbad.com/x/1", None),
        (9, "", None),
        (1, "http://WWW.Bad.COM/x/Page?q=1#top", None),
        (None, "http://evil.org/", None),
        (10, "ftp://é.net?x=/es/", None),
    ]
    assert judged(spark, rows) == [
        (1, "www.bad.com", "/x/Page", "bad.com/x/", "block"),
        (1, "www.bad.com", "/x/Page", "bad.com/x/", "block"),
        (2, "a.ok.bad.com", "/x/1", "ok.bad.com/x/", "allow"),
        (3, "bad.com", "/y", "com/", "allow"),
        (4, "bad.com", "", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "site.net", "/es/1", "net/es/", "block"),
        (8, "notbad.com", "/x/1", "com/", "allow"),
        (9, "", "", None, "allow"),
        (10, "é.net", "", None, "allow"),
        (None, "evil.org", "/", "evil.org/", "block"),
    ]


def test_aliases_carry_verdicts(spark):
    rows = [
        (1, "http://mirror.org/a", canonical("https://evil.org/page")),
        (2, "http://copy.org/b", '<meta http-equiv="refresh" content="0; url=http://mirror.org/a#x">'),
        (3, "http://other.org/c", canonical("//copy.org/b")),
        (4, "http://free.org/", None),
        (5, "http://saved.org/d", canonical("http://evil.org/q")),
        (6, "http://saved.org/e", canonical("/d")),
        (7, "https://evil.org/q", canonical("http://good.com/z")),
        (8, "http://chain.org/1", None),
    ]
    moved = spark.createDataFrame(
        [("http://chain.org/1", "http://chain.org/2"), ("http://evil.org/end", "http://chain.org/2"), (None, "http://x.org/")],
        "source string, target string",
    )
    verdicts = {r[0]: (r[3], r[4]) for r in judged(spark, rows, redirects=moved)}
    assert verdicts == {
        1: (None, "block"),
        2: (None, "block"),
        3: (None, "block"),
        4: (None, "allow"),
        5: (None, "allow"),  # one of its aliases is allowed
        6: (None, "allow"),
        7: ("evil.org/", "block"),  # its own rule
        8: (None, "block"),
    }


def refresh(content):
    return f"<meta http-equiv=refresh content='{content}'>"


def test_targets_are_resolved(spark):
    base = "<base href='/deep/er/'>"
    cases = [
        ("http://site.org/", "<meta http-equiv=refresh content=\"0; url=es/index.html\">", "site.org/es/index.html"),
        ("http://site.org/a/b?q#f", canonical("c/d"), "site.org/a/c/d"),
        ("http://site.org/a/b?q", canonical("?x=1"), "site.org/a/b?x=1"),
        ("http://site.org", canonical("es/"), "site.org/es/"),
        ("http://site.org/a/b/c", canonical("../x/./y?z=../w"), "site.org/a/x/y?z=../w"),
        ("http://site.org/a/b/c", canonical("../../../.."), "site.org/"),
        ("http://site.org/a/b/c", canonical(".."), "site.org/a/"),
        ("http://site.org/a/b", canonical("http://t.org/?a=1&amp;b=2&#38;c=&amp;amp;"), "t.org/?a=1&b=2&c=&amp;"),
        ("http://site.org/a/b", refresh("5; URL=//t.org/x?a=1&amp;b=2;c"), "t.org/x?a=1&b=2;c"),
        ("http://site.org/a/b", refresh('0;url="t/u"'), "site.org/a/t/u"),
        ("http://site.org/a/b", refresh("0; login?next=http://t.org/"), "site.org/a/login?next=http://t.org/"),
        ("http://site.org/a/b", refresh("30"), None),
        ("http://site.org/a/b", refresh("0;url="), None),
        ("http://site.org/a/b", canonical("mailto:x@t.org"), None),
        ("http://site.org/a/b", canonical("#top"), None),
        ("http://site.org/a/b", base + canonical("x"), "site.org/deep/er/x"),
        ("http://site.org/a/b", canonical(" /it%20is here\n"), "site.org/it%20is%20here"),
        ("http://site.org/a/b", canonical("&#x2F;caf&#233;"), "site.org/café"),
        ("no scheme", canonical("x"), None),
    ]
    # each on a host of its own
    rows = [[x and x.replace("site.org", f"site{i}.org") for x in case] for i, case in enumerate(cases)]
    pages = spark.createDataFrame([row[:2] for row in rows], "url string, html string")
    found = {(r.a, r.b) for r in url_filters.document_edges(pages).collect()}
    assert found == {(url.split("//")[1].split("#")[0], target) for url, _, target in rows if target}


def test_all_links_of_a_page_carry_verdicts(spark):
    rows = [
        (1, "http://site.net/", '<meta http-equiv=refresh content="0; url=es/index.html">'),
        (2, "http://two.org/", canonical("http://free.org/") + canonical("http://evil.org/p")),
        (3, "http://three.org/", refresh("1; url=http://free.org/") + refresh("2; url=http://free.org/q?a=1&amp;b=2")),
        (4, "http://free.org/q?a=1&b=2", canonical("http://two.org/")),
        (5, "http://five.org/", "<link rel=canonical>" + canonical("")),
    ]
    verdicts = {r[0]: (r[3], r[4]) for r in judged(spark, rows)}
    assert verdicts == {k: (None, "block") for k in (1, 2, 3, 4)} | {5: (None, "allow")}


def test_empty_tables_and_no_rules(spark):
    assert judged(spark, []) == []
    pages = spark.createDataFrame([(1, "http://a.com/", None)], "page_id long, url string, html string")
    found = url_filters.judge(pages, url_filters.rule_table(spark, []))
    assert [tuple(r) for r in found.collect()] == [(1, "a.com", "/", None, "allow")]


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    edges += [(None, 1), (2, None), (5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components.connected_components(frame, "a", "b").collect()}
    assert found == {x: find(x) for x in root}
    assert components.connected_components(frame.where(F.lit(False)), "a", "b").collect() == []


TARGET = "https://evil.org/page"
LINKS = [
    f'<link rel="nofollow canonical" href="{TARGET}">',
    f'<link title="a>b" rel="canonical" href="{TARGET}">',
    f"<LINK HREF={TARGET} REL=Canonical>",
    f"<link title=it's rel=canonical href={TARGET}><p>it's",
    f"<link\nrel = 'x\tcanonical'\n href = '{TARGET}' />",
    f'<meta content="0;url={TARGET}" http-equiv=" Refresh ">',
    f'<!-- a --><link rel=canonical href="{TARGET}"><!-- b -->',
    f'<script>var a = "<!--";</script><link rel=canonical href="{TARGET}">',
    f'<base href="https://evil.org/x/"><link rel=canonical href="../page">',
]
NO_LINKS = [
    f'<!-- <link rel="canonical" href="{TARGET}"> -->',
    f"<script>var a = '<link rel=canonical href={TARGET}>';</script>",
    f'<link data-rel="canonical" href="{TARGET}">',
    f'<link rel="canonical-old" href="{TARGET}">',
    f"""<link title=' rel="canonical" ' href="{TARGET}">""",
    f'<linkage rel="canonical" href="{TARGET}">',
    f'<link rel="canonical" data-href="{TARGET}">',
    f'<style>/* <link rel=canonical href="{TARGET}"> */</style>',
    f'<textarea><link rel=canonical href="{TARGET}"></textarea>',
    f'<link rel=canonical title="href={TARGET}">',
    f'<!-- unclosed <link rel=canonical href="{TARGET}">',
]


def test_links_are_cut_as_browsers_cut_them(spark):
    rows = [(n, f"http://page{n}.net/a", html) for n, html in enumerate(LINKS + NO_LINKS)]
    got = [r[4] for r in judged(spark, rows)]
    assert got == ["block"] * len(LINKS) + ["allow"] * len(NO_LINKS)


class Reader(html.parser.HTMLParser):
    """The links of a page by the standard library."""

    def __init__(self, url):
        super().__init__()
        self.base, self.found, self.based = url, set(), False

    def handle_starttag(self, tag, attrs):
        values = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        if tag == "link" and "canonical" in values.get("rel", "").lower().split():
            self.found.add(values.get("href"))

    handle_startendtag = handle_starttag


def test_random_tags_equal_a_parser(spark):
    rng = random.Random(6)
    rels = ["canonical", "nofollow canonical", "canonical-old", "CANONICAL", "stylesheet", ""]
    rows = []
    for n in range(400):
        parts = []
        for k in range(rng.randint(1, 3)):
            attrs = [f"rel={q}{rng.choice(rels)}{q}" for q in rng.choice(["\"", "'"])]
            attrs += [f'href="http://t{n}.org/{k}"', 'title="a > b"', "data-rel='canonical'", "hidden", "x='href=no'"][: rng.randint(1, 5)]
            rng.shuffle(attrs)
            tag = f"<{rng.choice(['link', 'LINK', 'a', 'link'])} {' '.join(attrs)}{rng.choice(['', ' /'])}>"
            parts.append(rng.choice(["{}", "<!-- {} -->", "<p>{}</p>", "<script>{}</script>", "<style>{}</style>"]).format(tag))
        rows.append((n, f"http://p{n}.net/", " text ".join(parts)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {tuple(r) for r in url_filters.document_edges(pages).collect()}
    want = set()
    for n, _, text in rows:
        reader = Reader("")
        reader.feed(text)
        want |= {(f"p{n}.net/", target.removeprefix("http://")) for target in reader.found if target}
    assert got == want and len(want) > 50


def test_dots_of_long_paths(spark):
    far = "a/" * 12_000 + "../" * 12_000 + "page"
    rows = [(1, "http://long.net/", f'<link rel=canonical href="https://evil.org/{far}">'), (2, "http://q.net/", f'<link rel=canonical href="/{far}">')]
    edges = {r.a: r.b for r in url_filters.document_edges(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert edges["q.net/"] == "q.net/page"
