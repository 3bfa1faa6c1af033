"""Text of an html string.

``visible_text`` is a column expression. ``all_nodes`` keeps every string node,
comments and scripts included; that needs a tokenizer, so it is an Arrow UDF.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.text import collapse_whitespace

# Markup that carries no visible text.
INVISIBLE = r"(?si)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]*>"

# Character references decoded by visible_text, ampersand last.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"),
    ("&reg;", "\u00ae"),
    ("&middot;", "\u00b7"),
    ("&laquo;", "\u00ab"),
    ("&raquo;", "\u00bb"),
    ("&pound;", "\u00a3"),
    ("&euro;", "\u20ac"),
    ("&ndash;", "\u2013"),
    ("&mdash;", "\u2014"),
    ("&lsquo;", "\u2018"),
    ("&rsquo;", "\u2019"),
    ("&ldquo;", "\u201c"),
    ("&rdquo;", "\u201d"),
    ("&bull;", "\u2022"),
    ("&hellip;", "\u2026"),
    ("&amp;", "&"),
]

# Elements whose white space is kept as written.
PREFORMATTED = {"pre", "textarea"}
ASCII_SPACE = " \t\n\r\x0b\x0c"


NUMBER = r"&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"


def numeric_references(text: Column) -> Column:
    """``&#8364;`` and ``&#x20ac;`` to their characters; numbers that are no character to U+FFFD."""

    def char(number: Column) -> Column:
        hexadecimal = F.lower(F.left(number, F.lit(1))) == "x"
        code = F.when(hexadecimal, F.conv(F.substr(number, F.lit(2)), 16, 10)).otherwise(number).cast("int")
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")

    rest = F.split(text, NUMBER, -1)
    chars = F.transform(F.regexp_extract_all(text, F.lit(NUMBER), 1), char)
    joined = F.array_join(F.zip_with(rest, chars, lambda a, c: F.concat(a, F.coalesce(c, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&#")), joined).otherwise(text)


def visible_text(html: Column) -> Column:
    """What a reader sees: no comments, scripts, styles or tags."""
    text = numeric_references(F.regexp_replace(html, INVISIBLE, " "))
    for reference, char in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    return collapse_whitespace(text)


class _NodeCollector(HTMLParser):
    """Collects string nodes; adjoining text and references form one node."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self._pending: list[str] = []
        self._preformatted = 0

    def flush(self):
        node = "".join(self._pending)
        self._pending.clear()
        if node and not node.strip(ASCII_SPACE) and not self._preformatted:
            node = "\n" if "\n" in node else " "
        if node:
            self.nodes.append(node)

    def _standalone(self, node):
        self.flush()
        self._pending.append(node)
        self.flush()

    def handle_data(self, data):
        self._pending.append(data)

    def handle_starttag(self, tag, attrs):
        self.flush()
        self._preformatted += tag in PREFORMATTED

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        if tag in PREFORMATTED and self._preformatted:
            self._preformatted -= 1

    def handle_comment(self, data):
        self._standalone(data)

    def handle_pi(self, data):
        self._standalone(data)

    def handle_decl(self, decl):
        name, _, rest = decl.partition(" ")
        self._standalone(rest if name.lower() == "doctype" else decl)

    def unknown_decl(self, data):
        self._standalone(data.removeprefix("CDATA["))


def string_nodes(html: str) -> list[str]:
    """Every string node of the document, in order."""
    collector = _NodeCollector()
    collector.feed(html)
    collector.close()
    collector.flush()
    return collector.nodes


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nodes_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else string_nodes(h))


def all_nodes(html: Column) -> Column:
    """``array<string>`` of every string node."""
    return _nodes_udf(html)
