"""Text of HTML. Parsing HTML has no built-in expression, so this one step is an
Arrow-batched pandas UDF over the standard library's parser."""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F

# Elements whose text is not document text, elements that keep
# their whitespace, elements that never hold anything, and what counts as blank.
SILENT_ELEMENTS = frozenset(("rp", "rt", "script", "style", "template"))
VERBATIM_ELEMENTS = frozenset(("pre", "textarea"))
VOID_ELEMENTS = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame",
    "hr", "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta",
    "nextid", "param", "source", "spacer", "track", "wbr",
))
BLANK = " \n\t\f\r"

_OPEN_REFERENCE = re.compile(r"&#?[0-9A-Za-z]*$")


class _TextNodes(HTMLParser):
    """Collects text nodes, tracking which elements are open around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.text: list[str] = []
        self.node: list[str] = []
        self.open: list[str] = []

    def end_node(self) -> None:
        node = "".join(self.node)
        self.node.clear()
        if not node or not SILENT_ELEMENTS.isdisjoint(self.open):
            return
        if not node.strip(BLANK) and VERBATIM_ELEMENTS.isdisjoint(self.open):
            node = "\n" if "\n" in node else " "
        self.text.append(node)

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag not in VOID_ELEMENTS:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.end_node()

    def handle_endtag(self, tag):
        self.end_node()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        self.node.append(data)

    def handle_charref(self, name):
        self.node.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.node.append(html5.get(f"{name};") or html5.get(name) or f"&{name}")

    def handle_comment(self, data):
        self.end_node()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.end_node()
        if data.upper().startswith("CDATA["):
            self.node.append(data[len("CDATA["):])
            self.end_node()


def html_text(html: str | None) -> str | None:
    """Text nodes only, entities decoded; nothing in, null out.

    A text node of nothing but blanks counts as one newline or one space.
    """
    if not html:
        return None
    parser = _TextNodes()
    parser.feed(html)
    if _OPEN_REFERENCE.search(html):
        # The parser would drop the ampersand of a reference cut off by the end.
        parser.feed("<!---->")
    parser.close()
    parser.end_node()
    return "".join(parser.text)


def strip_html(html: Column) -> Column:
    @F.pandas_udf("string")
    def text_of(batch: pd.Series) -> pd.Series:
        return batch.map(html_text)

    return text_of(html)
