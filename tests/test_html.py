"""Page text and links."""

from __future__ import annotations

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st

from gleanery.functions.html import VOID_TAGS, extract_text, hrefs, page_text
from gleanery.functions.urls import with_target
from gleanery.operators.links import extract_links, resolve_links
from tests.test_text import evaluate

PAGES = {
    "body only": ("<html><head><title>t</title></head><body> a <b>b</b>c </body></html>", "a\nb\nc"),
    "content wins": ("<body>x<div id='content'>y<p>z</p></div>w</body>", "y\nz"),
    "first content": ("<body><div id=content>1</div><div id=content>2</div></body>", "1"),
    "content needs a div": ("<body><p id='content'>y</p>w</body>", "y\nw"),
    "content is case sensitive": ("<body><div id='Content'>y</div>w</body>", "y\nw"),
    "content inside nav goes": ("<body><nav><div id='content'>y</div></nav>w</body>", "w"),
    "content without body": ("<div id='content'>y</div>z", "y"),
    "no body": ("<p>text</p>", ""),
    "removed": ("<body><header>h</header>a<nav>n</nav><style>s</style><script>if(a<b){}</script>b<footer>f</footer></body>", "a\nb"),
    "nested removed": ("<body><nav>1<header>2</header>3</nav>4</body>", "4"),
    "unclosed nav ends with its parent": ("<body><div><nav>n</div>after</body>", "after"),
    "stray end tags": ("<body></nav></p>a</b>b</body>", "a\nb"),
    "end tag closes what is inside": ("<body><div><span>a</div>b</span>c</body>", "a\nb\nc"),
    "comments split": ("<body>wo<!-- x -->rd</body>", "wo\nrd"),
    "entities": ("<body>a &amp; b&lt;c &copy &bogus; &#65;&#x42; &#150;</body>", "a & b<c © &bogus AB –"),
    "entity at the end": ("<body>x &amp;</body>", "x &"),
    "script with tags": ("<body><script>var t='</p><nav>';</script>a</body>", "a"),
    "void tags": ("<body>a<br>b<img src=x>c<br/>d</br>e</body>", "a\nb\nc\nd\ne"),
    "self closed": ("<body>a<nav/>b<div id='content'/>c</body>", ""),
    "template is silent": ("<body>a<template>b<p>c</p></template><ruby>d<rt>e</rt></ruby></body>", "a\nd"),
    "cdata": ("<body>a<![CDATA[b]]>c</body>", "a\nb\nc"),
    "upper case": ("<BODY>a<NAV>b</NAV></BODY>", "a"),
    "unclosed body": ("<body><p>a<p>b", "a\nb"),
    "text after body": ("<body>a</body>b", "a"),
    "whitespace nodes": ("<body> \n <p>   </p> a\n b </body>", "a\n b"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_page_text(name):
    html, want = PAGES[name]
    assert page_text(html) == want


def test_extract_text_runs_on_spark(spark):
    cases = [html for html, _ in PAGES.values()] + [None]
    assert evaluate(spark, extract_text, cases) == [want for _, want in PAGES.values()] + [None]


LINK_PAGES = [
    ('<a href="/a">1</a><a class=x href=\'/b\'>2</a><A HREF=/c>3</A>', ["/a", "/b", "/c"]),
    ('<a\nhref = "/a" >x</a><a name="n">y</a><abbr href="/no"></abbr>', ["/a"]),
    ('<!-- <a href="/no"> --><script>"<a href=\'/no\'>"</script><a href="/a">', ["/a"]),
    ('<a title="href=\'/no\'" data-href="/no" href="/a">', ["/a"]),
    ('<a href="/a" href="/no"><a href="">e</a><a href>n</a>', ["/a", ""]),
    ('<a title="a > b" href="/a">', ["/a"]),
    ('<textarea><a href="/no"></textarea><title><a href="/no"></title><a href=/a>', ["/a"]),
    ('<!-- unclosed <a href="/no">', []),
    ("<a " + "x=1 " * 20000 + 'href="/a">', ["/a"]),
    ("", []),
]


def test_hrefs(spark):
    assert evaluate(spark, hrefs, [html for html, _ in LINK_PAGES]) == [want for _, want in LINK_PAGES]


def test_links_are_decoded_and_placed(spark):
    pages = spark.createDataFrame(
        [("http://h.org/", '<a href="/x?a=1&amp;b=2">1</a><a href="#t">2</a><a href="/x?a=1&amp;b=2">3</a>')],
        "url string, html string",
    )
    got = [(r.pos, r.href) for r in extract_links(pages).orderBy("pos").collect()]
    assert got == [(0, "/x?a=1&b=2"), (1, "#t"), (2, "/x?a=1&b=2")]
    assert resolve_links(extract_links(pages)).count() == 2


RESOLVED = [
    ("https://h.org/p/q", "/x", "https://h.org/x"),
    ("HTTP://H.Org:80/p", "/x", "http://h.org/x"),
    ("https://u@h.org:8443/p", "/x", "https://u@h.org:8443/x"),
    ("https://h.org/p", "//Other.org/y", "https://other.org/y"),
    ("https://h.org/p", "//other.org:443", "https://other.org/"),
    ("https://h.org/p", "/a/./b/../c", "https://h.org/a/c"),
    ("https://h.org/p", "/../../a/..", "https://h.org/"),
    ("https://h.org/p", "/a/b/.", "https://h.org/a/b/"),
    ("https://h.org/p", "/..a/.b", "https://h.org/..a/.b"),
    ("https://h.org/p", "/é b?q=ü#€", "https://h.org/%C3%A9%20b?q=%C3%BC#%E2%82%AC"),
    ("https://h.org/p", "/a?x=../y", "https://h.org/a?x=../y"),
    ("https://h.org/p", "/😀", "https://h.org/%F0%9F%98%80"),
    ("https://h.org/p", "/a\\b\n", "https://h.org/a/b"),
    ("https://h.org/p", "/%zz/a.b/~c?x#y", "https://h.org/%zz/a.b/~c?x#y"),
    ("https://h.org/p", "/a//b", "https://h.org/a//b"),
    ("https://h.org/p", "/.hidden", "https://h.org/.hidden"),
    ("https://h.org/p", "/" + "a/" * 5000, "https://h.org/" + "a/" * 5000),
    ("https://h.org/p", "/{a}`", "https://h.org/%7Ba%7D%60"),
    ("https://h.org/p", "///x", None),
    ("https://h.org:/p", "/x", "https://h.org/x"),
    ("https://h.org/p", "http://Other.org/Ü", "http://Other.org/Ü"),
    ("https://h.org/p", "httpx:y", "httpx:y"),
    ("https://h.org/p", "#top", None),
    ("https://h.org/p", "mailto:a@b", None),
    ("https://h.org/p", "page.html", None),
    ("https://h.org/p", "HTTP://h.org", None),
    ("https://h.org/p", "", None),
    ("nonsense", "/x", None),
]


def test_with_target(spark):
    df = spark.createDataFrame([(n, *case) for n, case in enumerate(RESOLVED)], "n int, url string, href string, want string")
    got = {r.n: r.target for r in with_target(df).collect()}
    assert got == {n: want for n, (_, _, want) in enumerate(RESOLVED) if want is not None}


class Tree(HTMLParser):
    """The whole document as nested lists, the slow and plain way."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.root = ["#root", {}, []]
        self.path = [self.root]
        self.fresh = True

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        self.path[-1][2].append(node)
        if tag not in VOID_TAGS:
            self.path.append(node)
        self.fresh = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = max((n for n, node in enumerate(self.path) if node[0] == tag), default=None)
        self.path = self.path[:at] if at else self.path
        self.fresh = True

    def handle_data(self, data):
        children = self.path[-1][2]
        if self.fresh or not children or not isinstance(children[-1], str):
            children.append("")
        children[-1] += data
        self.fresh = False

    def handle_comment(self, data):
        self.fresh = True


def tree_text(html):
    tree = Tree()
    tree.feed(html)
    tree.close()

    def prune(node):
        node[2] = [c for c in node[2] if isinstance(c, str) or c[0] not in ("script", "style", "footer", "header", "nav")]
        for child in node[2]:
            if not isinstance(child, str):
                prune(child)

    def walk(node):
        yield node
        for child in node[2]:
            if not isinstance(child, str):
                yield from walk(child)

    def texts(node, silent=False):
        for child in node[2]:
            if isinstance(child, str):
                if child.strip() and not silent:
                    yield child.strip()
            else:
                yield from texts(child, silent or child[0] in ("template", "rt", "rp"))

    def under(root):
        """Whether a silent element encloses the root."""
        for node in walk(tree.root):
            if node[0] in ("template", "rt", "rp") and any(n is root for n in walk(node)):
                return True
        return False

    prune(tree.root)
    nodes = list(walk(tree.root))
    root = next((n for n in nodes if n[0] == "div" and n[1].get("id") == "content"), None)
    root = root or next((n for n in nodes if n[0] == "body"), None)
    return "\n".join(texts(root, under(root))) if root else ""


piece = st.sampled_from(
    ["a", " b ", "<div>", "</div>", "<div id=content>", "<body>", "</body>", "<nav>", "</nav>", "<header>", "</header>"]
    + ["<p>", "</p>", "<br>", "<script>x<p></script>", "<!-- c -->", "<template>", "</template>", "<nav/>", "<span>", "</span>"]
)


@settings(max_examples=600, deadline=None)
@given(st.lists(piece, max_size=25).map("".join))
def test_stream_of_tags_equals_the_tree(html):
    assert page_text(html) == tree_text(html)


def test_references_in_attributes():
    from gleanery.functions.html import unescape_attribute

    cases = {
        "/s?a=1&region=eu&section=2&current=3&notify=4&copy=5": "/s?a=1&region=eu&section=2&current=3&notify=4&copy=5",
        "/s?a&copy;b&copy": "/s?a\u00a9b\u00a9",
        "/s?a=1&amp;b=2&#38;c=3&#x26;d": "/s?a=1&b=2&c=3&d",
        "&copy2 &unknown; &amp= &ampx; & &;": "&copy2 &unknown; &amp= &ampx; & &;",
        "&amp;=1": "&=1",
    }
    assert {c: unescape_attribute(c) for c in cases} == cases
