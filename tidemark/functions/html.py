"""Anchors and the table row around them, from HTML text.

Nearly every page is read with split and regexp expressions inside the JVM, each
linear in the length of the page. A page those expressions cannot read faithfully
(nested or unclosed rows, unclosed anchors, anchors with a bare href, templates, text
areas, rarer character references) is detected per page and read by the standard
library's HTML parser in a pandas UDF instead; of any other page Python gets a null.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let, quoted, strip_sql

ANCHORS = "array<struct<href:string,title:string,category:string>>"

_INVISIBLE = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"
# Elements whose content only the parser treats rightly, and anchors whose href has no value.
_UNPLAIN = r"(?is)<(?:template|textarea|xmp|plaintext|listing)[\s/>]|<a\s(?:[^>]*?[\s\"'/])?href\s*+(?!\s*=)"
_ATTRIBUTES = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
_TAG = rf"""<[A-Za-z/!?]{_ATTRIBUTES}>"""
_ROWS = r"(?i)(?=<tr[\s/>])|(?<=</tr>)"
_REFERENCE = r"&[A-Za-z#]"
# The references decoded in the JVM; `amp` last, so that no text is decoded twice.
_COMMON_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}
_RARE_REFERENCE = r"&(?!(?:lt|gt|quot|apos|nbsp|amp);)[A-Za-z#]"


def _decode(text: str) -> str:
    decoded = text
    for reference, char in _COMMON_REFERENCES.items():
        decoded = f"replace({decoded}, {quoted(reference)}, {quoted(char)})"
    return f"if(contains({text}, '&'), {decoded}, {text})"


def _text(fragment: str) -> str:
    """Text nodes, each stripped, joined without a separator."""
    return f"array_join(transform(split({fragment}, {quoted(_TAG)}), t -> {strip_sql(_decode('t'))}), '')"


def _attribute(tag: str, name: str) -> str:
    pattern = quoted(rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    value = ", ".join(f"regexp_extract(g, {pattern}, {i})" for i in (1, 2, 3))
    return let("g", tag, f"if(rlike(g, {pattern}), concat({value}), null)")


def _starts(piece: str, tag: str) -> str:
    return f"rlike({piece}, {quoted(rf'(?i)^<{tag}[\s/>]')})"


def _elements(fragment: str, tag: str) -> str:
    """Pieces of `fragment`, each from an opening `tag` to the first closing one."""
    pieces = f"split({fragment}, {quoted(rf'(?i)(?=<{tag}[\s/>])')})"
    return f"transform(filter({pieces}, p -> {_starts('p', tag)}), p -> split(p, {quoted(rf'(?i)(?<=</{tag}[\s>])')}, 2)[0])"


def _opening(piece: str, tag: str) -> str:
    return f"regexp_extract({piece}, {quoted(rf'(?i)^<{tag}{_ATTRIBUTES}>')}, 1)"


def _inside(piece: str, tag: str) -> str:
    body = f"regexp_replace({piece}, {quoted(rf'(?i)^<{tag}{_ATTRIBUTES}>')}, '')"
    return f"split({body}, {quoted(rf'(?i)</{tag}[\s>]')}, 2)[0]"


def _closed(piece: str, tag: str) -> str:
    return f"rlike({piece}, {quoted(rf'(?i)</{tag}[\s>]')})"


def page_segments(html: str, category_header: str) -> str:
    """Page cut at table rows: per cut its anchors' pieces and the row's category cell."""
    header, in_row = quoted(category_header), _starts("s", "tr")
    labels = f"split(coalesce({_attribute(_opening('c', 'td'), 'headers')}, ''), {quoted(r'\s+')})"
    cells = f"filter({_elements('s', 'td')}, c -> array_contains({labels}, {header}))"
    described = (
        f"named_struct('anchors', {_elements('s', 'a')}, "
        f"'cell', if({in_row} AND contains(s, {header}), get({cells}, 0), null), "
        f"'open_row', {in_row} AND NOT {_closed('s', 'tr')})"
    )
    visible = f"regexp_replace({html}, {quoted(_INVISIBLE)}, '')"
    return f"transform(split({visible}, {quoted(_ROWS)}), s -> {described})"


def needs_parser(html: str, segments: str) -> str:
    """Whether a page holds something the expressions of `plain_anchors` misread."""
    rare = quoted(_RARE_REFERENCE)
    odd_anchor = (
        f"NOT {_closed('a', 'a')} OR NOT rlike(a, {quoted(rf'(?i)^<a{_ATTRIBUTES}>')}) OR rlike(a, {rare}) OR rlike({_opening('a', 'a')}, {quoted('(?is)href.*href')})"
    )
    odd_cell = (
        f"s.cell IS NOT NULL AND (NOT {_closed('s.cell', 'td')} OR rlike(s.cell, {rare}) "
        f"OR rlike(s.cell, {quoted(r'(?i)<table[\s>]')}))"
    )
    odd_segment = f"exists({segments}, s -> s.open_row OR {odd_cell} OR exists(s.anchors, a -> {odd_anchor}))"
    return f"coalesce(rlike({html}, {quoted(_UNPLAIN)}) OR {odd_segment}, false)"


def plain_anchors(segments: str) -> str:
    """Anchors with an href, in document order, as an array of structs."""
    href = strip_sql(_decode("h"))
    anchor = (
        f"named_struct('href', {let('h', _attribute(_opening('a', 'a'), 'href'), href)}, "
        f"'title', {_text(_inside('a', 'a'))}, 'category', category)"
    )
    of_segment = let(
        "category",
        f"coalesce({_text(_inside('s.cell', 'td'))}, '')",
        f"transform(s.anchors, a -> {anchor})",
    )
    return f"cast(filter(flatten(transform({segments}, s -> {of_segment})), a -> a.href IS NOT NULL) AS {ANCHORS})"


# HTML elements that never hold content.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _AnchorReader(HTMLParser):
    """Collects anchors, their text and the category cell of the nearest row.

    Text nodes are kept once, in order; an element remembers its first and last.
    """

    def __init__(self, category_header: str):
        super().__init__(convert_charrefs=True)
        self._header = category_header
        self._texts: list[str] = []
        self._node: list[str] = []
        self._open: list[tuple[str, dict]] = []
        self._count: Counter[str] = Counter()
        self._rows: list[dict] = []
        self._anchors: list[tuple[str, dict, dict]] = []

    def _end_node(self):
        text = "".join(self._node).strip()
        self._node = []
        if text and not any(self._count[tag] for tag in ("script", "style", "template")):
            self._texts.append(text)

    def _text(self, element: dict | None) -> str:
        return "".join(self._texts[element["first"] : element.get("end")]) if element else ""

    def handle_data(self, data):
        self._node.append(data)

    def handle_comment(self, data):
        self._end_node()

    def handle_starttag(self, tag, attrs):
        self._end_node()
        values = {name: value or "" for name, value in attrs}
        element = {"first": len(self._texts)}
        if tag == "td" and self._header in values.get("headers", "").split():
            for row in self._rows:
                row.setdefault("cell", element)
        if tag == "a" and "href" in values:
            self._anchors.append((values["href"], element, self._rows[-1] if self._rows else {}))
        if tag not in _VOID:
            self._open.append((tag, element))
            self._count[tag] += 1
            if tag == "tr":
                self._rows.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_node()
        # Closes whatever was left open inside it; without an opening tag it means nothing.
        closed = None if self._count[tag] else tag
        while closed != tag:
            closed, element = self._open.pop()
            element["end"] = len(self._texts)
            self._count[closed] -= 1
            if closed == "tr":
                self._rows.pop()

    def anchors(self, html: str) -> list[dict]:
        self.feed(html)
        self.close()
        self._end_node()
        return [
            {"href": href.strip(), "title": self._text(element), "category": self._text(row.get("cell"))}
            for href, element, row in self._anchors
        ]


def parsed_anchors(html: Column, category_header: str) -> Column:
    """Same result as `plain_anchors`, from the HTML parser; null stays null."""

    @F.pandas_udf(ANCHORS)
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else _AnchorReader(category_header).anchors(p))

    return read(html)
