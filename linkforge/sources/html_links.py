"""File lists from HTML that isn't well formed: anchors by an open-element stack.

``pages.page_links`` reads anchors with column expressions and holds where
elements are closed and not nested. Saved pages have unclosed tags, comments
and scripts with markup in them, attributes with ``>`` and hidden elements
within elements of their own name; those need a tokeniser. Here each page is
tokenised once, in Arrow batches (no shuffle), and its anchors come out:

* an anchor's text is all text within it, each fragment between tags or
  comments trimmed, without elements of the hidden class (and what is in them),
  comments, and the contents of scripts, styles and templates;
* an end tag closes the last open element of its name with all that is open
  inside; one that closes nothing is ignored; what is open at the end of the
  page ends there;
* an anchor within an anchor is an anchor of its own, and its text belongs to
  both.

Edge cases: null and empty pages have no anchors; anchors without text give no
row, but count for ``link_pos``, which is the anchor's place among all anchors
of the page. Repeated pages give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .pages import FILE_LINK_CLASS, HIDDEN_CLASS

# --- Fixed values: HTML elements without content, and those whose text isn't shown
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
UNSHOWN = {"script", "style", "template"}
# -------------------------------------------------------------------------
BATCH_LINKS = 5_000


@dataclass
class _Anchor:
    classes: list[str]
    fragments: list[str] = field(default_factory=list)


class _Links(HTMLParser):
    """Collects the anchors of one page."""

    def __init__(self, hidden: str):
        super().__init__(convert_charrefs=True)
        self.hidden = hidden
        self.anchors: list[_Anchor] = []
        # Open elements: name, the anchor it is, whether its text is left out of
        # the anchors opened before it.
        self.open: list[tuple[str, _Anchor | None, bool]] = []
        self.text: list[str] = []

    def _end_fragment(self) -> None:
        fragment = "".join(self.text).strip()
        self.text.clear()
        if not fragment or any(name in UNSHOWN for name, _, _ in self.open):
            return
        for _, anchor, left_out in reversed(self.open):
            if anchor is not None:
                anchor.fragments.append(fragment)
            if left_out:
                break

    def handle_starttag(self, tag, attrs):
        self._end_fragment()
        classes = next((value or "" for name, value in attrs if name == "class"), "").split()
        anchor = None
        if tag == "a":
            anchor = _Anchor(classes)
            self.anchors.append(anchor)
        if tag not in VOID:
            self.open.append((tag, anchor, self.hidden in classes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_fragment()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._end_fragment()

    def handle_decl(self, decl):
        self._end_fragment()

    def handle_pi(self, data):
        self._end_fragment()

    def unknown_decl(self, data):
        self._end_fragment()


def anchors_of(html: str | None, hidden: str = HIDDEN_CLASS) -> list[tuple[list[str], str]]:
    """(classes, text) of each anchor of a page, in document order."""
    parser = _Links(hidden)
    parser.feed(html or "")
    parser.close()
    parser._end_fragment()
    return [(a.classes, "".join(a.fragments)) for a in parser.anchors]


def page_links(pages: DataFrame, css_class: str | None = FILE_LINK_CLASS, hidden: str = HIDDEN_CLASS) -> DataFrame:
    """(page_id, link_pos, link_text): non-empty anchor texts in document
    order; ``css_class=None`` takes every anchor."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, htmls = batch.column("page_id"), batch.column("html")
            of, places, texts = [], [], []

            def links() -> pa.RecordBatch:
                return pa.record_batch({"page_id": ids.take(pa.array(of, pa.int64())), "link_pos": pa.array(places, pa.int32()),
                                        "link_text": pa.array(texts, pa.string())})

            for row in range(batch.num_rows):
                for place, (classes, text) in enumerate(anchors_of(htmls[row].as_py(), hidden)):
                    if text and (css_class is None or css_class in classes):
                        of.append(row)
                        places.append(place)
                        texts.append(text)
                if len(of) >= BATCH_LINKS:
                    yield links()
                    of, places, texts = [], [], []
            yield links()

    return pages.select("page_id", "html").mapInArrow(run, f"page_id {id_type}, link_pos int, link_text string")
