"""File lists from saved HTML pages: the text of the anchors of a CSS class.

Runs as column expressions over a ``pages(page_id, url, html)`` table:
anchors are extracted with one regex pass, elements of the hidden class are
removed, tags stripped, entities decoded, each text fragment trimmed and the
fragments joined (the way a stripped ``get_text`` joins them), and empty texts
skipped. A class matches when it is one of the white-space separated words of
the ``class`` attribute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws

# --- Fixed values --------------------------------------------------------
FILE_LINK_CLASS = "data-service-file-link"
HIDDEN_CLASS = "sr-only"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")]
# -------------------------------------------------------------------------

ANCHOR_RE = r"(?is)<a\b[^>]*>.*?</a>"


# A class attribute: double-quoted, single-quoted or bare value.
_CLASS_RE = r"""(?is)(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_NUMBER_RE = r"&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"
_LAST_POINT = 0x10FFFF


def _code_point(number: Column) -> Column:
    """The character of a numeric entity's number (``x41``, ``65``)."""
    hexadecimal = F.lower(F.substring(number, 1, 1)) == "x"
    point = F.when(hexadecimal, F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).cast("long")
    valid = (point > 0) & (point <= _LAST_POINT) & ~point.between(0xD800, 0xDFFF)
    spelt = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(number.isNotNull(), spelt)


def _unescape(c: Column) -> Column:
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    # numbers: the text between them stays, so that nothing is decoded twice
    numbers = F.regexp_extract_all(c, F.lit(_NUMBER_RE), 1)
    between = F.split(c, _NUMBER_RE, -1)
    glued = F.array_join(F.transform(between, lambda part, i: F.concat(
        part, F.coalesce(_code_point(F.get(numbers, i)), F.lit("")))), "")
    return F.replace(F.when(F.size(numbers) > 0, glued).otherwise(c), F.lit("&amp;"), F.lit("&"))


def _class_words(attributes: Column) -> Column:
    """The words of the class attribute (none: an empty array)."""
    value = F.concat(*[F.regexp_extract(attributes, _CLASS_RE, g) for g in (1, 2, 3)])
    return F.filter(F.split(value, r"\s+"), lambda w: w != "")


def _hidden_re(name: str) -> str:
    value = rf"""(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>/]))"""
    return rf"""(?is)<(\w+)(?=\s)(?:\s+(?!class\s*=)[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*\s+class\s*=\s*{value}[^>]*>.*?</\1\s*>"""


def anchor_text(anchor: Column) -> Column:
    inner = F.regexp_extract(anchor, r"(?is)^<a\b[^>]*>(.*)</a>$", 1)
    inner = F.regexp_replace(inner, _hidden_re(HIDDEN_CLASS), "")
    fragments = F.split(inner, r"<[^>]*>")
    return F.array_join(F.transform(fragments, lambda s: strip_ws(_unescape(s))), "")


def page_links(pages: DataFrame, css_class: str | None = FILE_LINK_CLASS) -> DataFrame:
    """(page_id, link_pos, link_text): non-empty anchor texts in document
    order; ``css_class=None`` takes every anchor."""
    anchors = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR_RE), 0))
                           .alias("link_pos", "anchor"))
    if css_class:
        attributes = F.regexp_extract("anchor", r"(?is)^<a\b([^>]*)>", 1)
        anchors = anchors.where(F.array_contains(_class_words(attributes), css_class))
    return (anchors.select("page_id", "link_pos", anchor_text(F.col("anchor")).alias("link_text"))
                   .where(F.col("link_text") != ""))


def page_link_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"))
