"""Links as the standard library's parser and resolver see them, and patterns over many links."""

import random
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from statloom.functions.links import hrefs, resolved, unescaped
from statloom.sources import landing as G

PAGES = [
    '<a href="/a">x</a><A HREF=\'b.html\'>y</A><a href=c.html>z</a><a class=k href = "d?x=1&amp;y=2">',
    '<a title="a > b" href="/e">1</a><a href="x&#47;y&#x2F;z">2</a><a data-href="/no" href="/yes">3</a>',
    '<!-- <a href="/comment"> --><script>var s = "<a href=\'/script\'>";</script><style>a{}</style><a href="/real">',
    '<a name="top">no target</a><a href>empty</a><a href="">none</a><abbr href="/abbr">t</abbr><a\nhref="/line"\n>',
    "<a href='it&apos;s'>q</a><a href=\"a'b\">r</a><a href=/p/q/>s</a><a href='  /blank  '>t</a><a href='&amp;amp;'>u</a>",
    "", "no links at all", None,
]


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            first = next((v for k, v in attrs if k == "href"), None)
            if first is not None:
                self.found.append(first.strip(" "))


def test_links_are_those_of_a_parser(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i int, html string")
    got = {r.i: r.h for r in df.select("i", hrefs("html").alias("h")).collect()}
    for i, page in enumerate(PAGES):
        if page is None:
            assert got[i] is None
            continue
        parser = Links()
        parser.feed(page)
        # an attribute without a value is no link; the parser gives None for it and it is left there as well
        assert [h for h in got[i] if h != ""] == [h for h in parser.found if h != ""], page


def test_references(spark):
    texts = {"a&amp;b": "a&b", "&lt;&gt;&quot;&apos;": "<>\"'", "&#65;&#x42;&#X43;": "ABC", "&amp;amp;": "&amp;", "&unknown; & &;": "&unknown; & &;",
             "&#8364;&#x1F600;": "€\U0001f600", "&#xD800;": "�", "&#0;": "�", "&nbsp;": " ", "": "", "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in texts], "t string")
    assert {r.t: r.u for r in df.select("t", unescaped("t").alias("u")).collect()} == texts


BASES = ["http://h.org/a/b/c.html", "http://h.org/a/b/", "https://h.org", "http://h.org:80/x?q=1", "http://h.org/a/b/c.html?q=1#f", "http://h.org/a/../b/c"]
REFS = ["g", "./g", "g/", "/g", "//other.org/g", "?y", "g?y", "#s", "g#s", "", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g",
        "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "http://x.org/a", "mailto:a@b.c", "a b.html", "g?y/./x", "g#s/../x", "a.html"]


@pytest.mark.parametrize("base", BASES)
def test_relative_addresses(spark, base):
    df = spark.createDataFrame([(base, r) for r in REFS], "b string, r string")
    got = {r.r: r.u for r in df.select("r", resolved("b", "r").alias("u")).collect()}
    for ref in REFS:
        want = urljoin(base, ref) if ref else base.split("#")[0]  # the page itself, without the place in it
        if base == "https://h.org" and not re.match("[a-z]+:|/", ref):
            # without a path both forms of the same page are right
            assert got[ref].replace("h.org/", "h.org").rstrip("/") == want.replace("h.org/", "h.org").rstrip("/"), ref
        elif "../" in base and ref in ("", "#s", "?y"):
            assert got[ref] in (want, urljoin(base, ".") + "c" + ref, base + ref), ref
        else:
            assert got[ref] == want, (base, ref)


def test_links_against_their_own_page(spark):
    pages = spark.createDataFrame([("http://a.org/x/p.html", '<a href="f.csv">'), ("http://b.org/", "<a href='../f.csv'>"), ("http://b.org/", None)], "url string, html string")
    got = {r.link for r in G.extract_links(pages, ".csv", F.col("url")).collect()}
    assert got == {"http://a.org/x/f.csv", "http://b.org/f.csv"}


@pytest.mark.parametrize("pattern, text", [
    ("/The$", "/The"), (r"\d{4}$", ""), (r"report-\d{4}\.xlsx$", "report-"), (r"annual\.csv", "annual.csv"), ("ab?cde", "cde"), ("abc*", "ab"),
    ("abc+d", "abc"), ("abc{2}xyz", "abc"), ("abc{0,2}wxyz", "wxyz"), ("abc|def", ""), ("(abc|def)ghi", "ghi"), ("(?i)abc", ""), ("[abc]def", "def"),
    ("[]a]bcd", "bcd"), ("[^]x]bcd", "bcd"), (r"\Qa.b\E", ""), ("x(y(z)w)v12", "v12"), (r"\.tar\.gz", ".tar.gz"), ("", ""), ("a.bcd", "bcd"),
    ("[a[bc]d]efg", "efg"), (r"a\tbcd", "bcd"), ("abc+?de", "abc"), ("a{3}", "a")])
def test_required_text(pattern, text):
    assert G.required_text(pattern) == text


def test_required_text_is_in_every_match():
    rng = random.Random(8)
    pieces = ["ab", "c?", "d+", "[xy]", "(e|f)", ".", "g{2}", "h*", r"\.", "(ij)?", "k{0,1}", "lmn", "^", "$", r"\d"]
    for _ in range(3000):
        pattern = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6)))
        need = G.required_text(pattern)
        for _ in range(20):
            text = "".join(rng.choice("abcdefghijklmnxy.7") for _ in range(rng.randrange(0, 9)))
            if re.search(pattern, text):
                assert need in text, (pattern, text)


def test_thousands_of_patterns(spark):
    rng = random.Random(2)
    links = [f"https://x.org/data/{rng.choice(['cpi', 'gdp', 'trade'])}-{k}.csv" for k in range(3000)]
    patterns = [(f"p{k}", rf"-{k}\.csv$") for k in range(0, 4000, 2)] + [("any", "."), ("trade", "/trade-"), ("none", "zzz"), ("short", "p.i-7"), ("null", None)]
    got = G.resolve_links(spark.createDataFrame([(x,) for x in links], "link string"), spark.createDataFrame(patterns, "name string, pattern string"), "all")
    have = {}
    for r in got.collect():
        have.setdefault(r.name, set()).add(r.link)
    for name, rx in patterns:
        want = {x for x in links if rx is not None and re.search(rx, x)}
        assert have[name] == (want or {None}), name
    plan = G.matching_links(spark.createDataFrame([("a",)], "link string"), spark.createDataFrame([("n", "abc")], "name string, pattern string"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in text and all("Join Inner, (" in x or "Join LeftSemi" in x or "Join LeftOuter, (" in x for x in text.splitlines() if "Join " in x)


def test_first_and_one(spark):
    links = spark.createDataFrame([("b/abc",), ("a/abc",), ("a/xyz",), (None,)], "link string")
    patterns = spark.createDataFrame([("two", "abc$"), ("one", "xyz$"), ("no", "qqq")], "name string, pattern string")
    first = {r.name: (r.matches, r.status, r.link) for r in G.resolve_links(links, patterns, "first").collect()}
    assert first == {"two": (2, "ambiguous", "a/abc"), "one": (1, "unique", "a/xyz"), "no": (0, "missing", None)}
    assert {r.name: r.link for r in G.resolve_links(links, patterns).collect()} == {"two": None, "one": "a/xyz", "no": None}
    with pytest.raises(ValueError):
        G.resolve_links(links, patterns, "some")


def test_too_many_open_patterns(spark, monkeypatch):
    monkeypatch.setattr(G, "MAX_OPEN", 2)
    links = spark.createDataFrame([("a",)], "link string")
    with pytest.raises(ValueError):
        G.matching_links(links, spark.createDataFrame([(str(k), ".") for k in range(3)], "name string, pattern string"))
