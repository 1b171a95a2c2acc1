"""One tolerant pass over a page: a small tree, and the few questions that the extraction asks of it.

Markup may leave elements open. A cell ends at the next cell or row, a row at the next row, an option at
the next option, an item at the next item, a paragraph at the next block. A text node is a run of text
between tags or comments; character references are decoded; nothing is trimmed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What a start tag ends, and the elements beyond which it ends nothing.
ENDS = {
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "li": ({"li"}, {"ul", "ol"}),
    **{tag: ({"p"}, {"td", "th", "li", "div", "article", "body"}) for tag in ("p", "div", "table", "ul", "ol", "h1", "h2", "h3", "article", "footer", "nav")},
}


#: A comment, a tag with what stands in it, or a declaration; anything else is text.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
#: Elements whose content is text up to their end tag.
RAW = {"script", "style"}
NONE: dict[str, str] = {}


class Element:
    __slots__ = ("tag", "inner", "read", "children")

    def __init__(self, tag: str, inner: str = ""):
        self.tag, self.inner, self.read = tag, inner, None
        self.children: list[Element | str] = []

    @property
    def attributes(self) -> dict[str, str]:
        """By name, the first of a name; read when first asked for, since most elements are never asked."""
        if not self.inner:
            return NONE
        if self.read is None:
            self.read = {}
            for name, a, b, c in ATTRIBUTE.findall(self.inner):
                self.read.setdefault(name.lower(), unescape(a or b or c))
        return self.read

    def elements(self, tag: str | None = None) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element) and (tag is None or c.tag == tag)]

    def walk(self) -> Iterator[Element]:
        """This element and all below, in document order."""
        open_ = [self]
        while open_:
            now = open_.pop()
            yield now
            open_.extend(reversed(now.elements()))

    def texts(self) -> list[str]:
        """Its own text nodes, not those of elements within."""
        return [c for c in self.children if isinstance(c, str) and c]

    def all_texts(self) -> Iterator[str]:
        open_: list[Element | str] = [self]
        while open_:
            now = open_.pop()
            if isinstance(now, str):
                if now:
                    yield now
            else:
                open_.extend(reversed(now.children))


def _end(open_: list[Element], tag: str) -> None:
    """Closes the innermost open element of that tag, if none of the tables between stands in the way."""
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag == tag:
            del open_[k:]
            return
        if open_[k].tag == "table" and tag not in ("table", "body", "html"):
            return


def _start(open_: list[Element], tag: str, inner: str) -> None:
    if tag in ENDS:
        ended, stop = ENDS[tag]
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag in stop:
                break
            if open_[k].tag in ended:
                del open_[k:]
    new = Element(tag, inner)
    open_[-1].children.append(new)
    if tag not in VOID and not inner.endswith("/"):
        open_.append(new)


def tree(html: str | None, decode: Callable[[str], str] = unescape) -> Element:
    """decode: of text nodes with character references; attributes are always decoded."""
    html, at = html or "", 0
    root = Element("")
    open_ = [root]
    while found := TOKEN.search(html, at):
        if found.start() > at:
            text = html[at : found.start()]
            open_[-1].children.append(decode(text) if "&" in text else text)
        at = found.end()
        if not (tag := found[2]):
            continue
        tag = tag.lower()
        if found[1]:
            _end(open_, tag)
            continue
        _start(open_, tag, found[3])
        if tag in RAW and open_[-1].tag == tag:
            close = re.compile(f"</{tag}", re.I).search(html, at)
            end = close.start() if close else len(html)
            open_[-1].children.append(html[at:end])
            at = end
    if at < len(html):
        open_[-1].children.append(decode(html[at:]))
    return root


def first(values) -> str | None:
    return next(iter(values), None)


def option_list(choices: list[Element]) -> list[dict]:
    """pos from 0, the first value attribute and the first text of each, at any depth."""
    return [{"pos": k, "value": first(e.attributes["value"] for e in c.walk() if "value" in e.attributes), "name": first(c.all_texts())} for k, c in enumerate(choices)]


def nth_cell_text(row: Element, k: int) -> str | None:
    """First text directly within a font directly within a td that is the k-th td of its parent."""
    for e in row.walk():
        cells = e.elements("td")
        if len(cells) >= k:
            for font in cells[k - 1].elements("font"):
                if texts := font.texts():
                    return texts[0]
    return None


def cell_texts(row: Element, count: int) -> list[str | None]:
    """nth_cell_text for 1 to count, in one walk where cells aren't nested."""
    if any(e.tag == "td" for cell in row.elements("td") for child in cell.elements() for e in child.walk()):
        return [nth_cell_text(row, k) for k in range(1, count + 1)]
    cells = row.elements("td")
    return [next((t for f in c.elements("font") for t in f.texts()), None) for c in cells[:count]] + [None] * (count - len(cells))


def pager_text(row: Element) -> str | None:
    """First text of a font in the last cell of the tables' direct rows."""
    cells = [td for t in row.walk() if t.tag == "table" for tr in t.elements("tr") for td in tr.elements("td")]
    return first(t for e in cells[-1].walk() if e.tag == "font" for t in e.texts()) if cells else None


def grid_rows(table: Element, cells: int, tbody: bool) -> list[dict]:
    """The table's direct rows but the first; with tbody, rows within a tbody count as direct."""
    rows = [r for e in table.elements() for r in (e.elements("tr") if tbody and e.tag == "tbody" else [e]) if r.tag == "tr"]
    out = []
    for k, r in enumerate(rows[1:], 1):
        nested = any(e.tag == "table" for e in r.walk())
        out.append({"row_ord": k, "cells": cell_texts(r, cells), "has_table": nested, "pager": pager_text(r) if nested else None})
    return out
