"""HTML expressions.

Text extraction needs a tag stack (which element is open, which is removed), which no
built-in expression keeps, so it is one Arrow UDF around the stdlib tokenizer. Link
extraction needs no stack and stays a regular expression inside codegen; only the
short href values visit Python, to decode character references.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Fixed values.
REMOVED_TAGS = frozenset(["script", "style", "footer", "header", "nav"])
SILENT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen"
    " link menuitem meta nextid param source spacer track wbr".split()
)


class _PageText(HTMLParser):
    """Visible text nodes of the first ``div#content``, else of ``body``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[str] = []
        self.counts: Counter[str] = Counter()
        self.removed = self.silent = 0  # open elements of either kind
        self.run: list[str] = []
        self.nodes: dict[str, list[str]] = {}  # root -> its text nodes
        self.level: dict[str, int] = {}  # root still open -> its height in `open`

    def updatepos(self, i, j):  # line numbers, which nobody asks for
        return j

    def end_run(self) -> None:
        if not self.run:
            return
        node = "".join(self.run).strip()
        self.run.clear()
        if node and not self.removed and not self.silent:
            for root in self.level:
                self.nodes[root].append(node)

    def handle_starttag(self, tag, attrs):
        self.end_run()
        if tag in VOID_TAGS:
            return
        root = "body" if tag == "body" else None
        if tag == "div" and dict(attrs).get("id") == "content":
            root = "content"
        if root and root not in self.nodes and not self.removed:
            self.nodes[root] = []
            self.level[root] = len(self.open)
        self.open.append(tag)
        self._count(tag, 1)

    def _count(self, tag: str, change: int) -> None:
        self.counts[tag] += change
        if tag in REMOVED_TAGS:
            self.removed += change
        if tag in SILENT_TAGS:
            self.silent += change

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.end_run()
        while self.counts[tag]:
            last = self.open.pop()
            self._count(last, -1)
            if last in ("div", "body"):
                self.level = {root: at for root, at in self.level.items() if at < len(self.open)}
            if last == tag:
                break

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.run.append(unescape(f"&#{name};") or "�")

    def handle_comment(self, data):
        self.end_run()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.end_run()
        if data.upper().startswith("CDATA["):
            self.run.append(data[len("CDATA[") :])
            self.end_run()


def page_text(html: str | None) -> str | None:
    """Text of one page, one node per line; None when the markup cannot be tokenized."""
    if html is None:
        return None
    parser = _PageText()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # the tokenizer's verdict on broken `<![...` sections
        return None
    parser.end_run()
    return "\n".join(parser.nodes.get("content", parser.nodes.get("body", [])))


def extract_text(html: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def extract_text(pages: pd.Series) -> pd.Series:
        return pages.map(page_text, na_action="ignore")

    return extract_text(html)


# One scan finds comments and raw-text elements as well as anchors, so an anchor inside
# either is swallowed by it. Every loop is possessive: constant stack on long input.
_ANCHOR_OR_RAW = (
    r"(?is)<!--.*?(?:-->|$)"
    r"|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]).*?(?:</\1(?=[\s/>])|$)"
    r"""|<a(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
)
_HREF = (
    r"""(?is)^<a(?:[\s/]++(?!href[\s/=>])[^\s/=>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+)*+"""
    r"""[\s/]++href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)"""
)


def hrefs(html: Column) -> Column:
    """Raw href values of the page's anchors, in document order (entities not decoded)."""
    tags = F.regexp_extract_all(html, F.lit(_ANCHOR_OR_RAW), F.lit(0))
    values = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, _HREF, 1)), lambda v: v != "")
    return F.transform(values, lambda v: F.regexp_replace(v, """^["']|["']$""", ""))


_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)")


def unescape_attribute(value: str) -> str:
    """The value with its character references decoded. In an attribute a name without a
    semicolon that a letter, a digit or ``=`` follows is no reference: ``&region=eu``."""

    def decoded(found: re.Match) -> str:
        name = found[0][1:]
        if name.startswith("#"):
            return unescape(found[0])
        assigned = not name.endswith(";") and value[found.end() :].startswith("=")
        return found[0] if assigned else html5.get(name, found[0])

    return _REFERENCE.sub(decoded, value)


def unescape_html(text: Column) -> Column:
    """Attribute values decoded; those without a reference never leave the JVM's rows."""

    @F.pandas_udf(T.StringType())
    def unescape_html(values: pd.Series) -> pd.Series:
        return values.map(unescape_attribute, na_action="ignore")

    return F.coalesce(unescape_html(F.when(F.contains(text, F.lit("&")), text)), text)
