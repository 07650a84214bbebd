"""Listing pages (S14, J8, F2): raw page -> the numbered entries that it lists.

A listing is a definition list: each ``dt`` holds an item's number (a named
anchor) and its link, the ``dd`` that follows describes it.  End tags of
``dt``, ``dd``, ``li`` and ``p`` may be left out, as pages do, so the reader keeps
the open item as state and closes it where the next one begins.  A section
index on the page links to the number at which each section starts; entries
from the last section's start on are left out by ``cut``.

The page's tokenizer is the standard library's; it runs over Arrow batches,
one page at a time, and hands entries on as they come (``OUT_CHARS``), so a worker
holds one batch (of bounded bytes, ``session.SQL_CONFS``) and one page; Spark deals the pages.  ``Layout`` names the parts of
a page, so other listings of the same build can be read.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pages import target_overlap

SCHEMA = "page_id long, pos int, item_no long, id string, href string, subjects string, description string, cutoff long"
#: Characters of descriptions that a worker holds before it hands them on.
OUT_CHARS = 1 << 20
#: Elements without content: they never open.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: White space around a text node (as in ``text.clean_pieces``).
BLANKS = " \t\n\r\x0b\x0c"
#: What a start tag closes, up to the element that holds both.
CLOSES = {"dt": (("dt", "dd"), "dl"), "dd": (("dt", "dd"), "dl"), "li": (("li",), "ul ol"), "p": (("p",), "dd dt li td div dl body")}
#: Elements that a paragraph's text does not run into.
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


@dataclass(frozen=True)
class Layout:
    index_id: str = "dlpage"               # the element that holds the section index
    number_prefix: str = "item"            # of anchors that number items
    link_title: str = "Abstract"           # of an item's own link
    subjects_class: str = "list-subjects"
    primary_class: str = "primary-subject"


@dataclass
class _Entry:
    number: int | None = None
    href: str | None = None
    subjects: str | None = None            # of the primary subject
    other_subjects: str | None = None      # the subjects element's own first text
    text: list[str] = field(default_factory=list)
    described: bool = False


def _number(name: str | None, prefix: str) -> int | None:
    """The number behind the last ``prefix`` of a name, if there is one."""
    tail = (name or "").rpartition(prefix)
    return int(tail[2]) if tail[1] and tail[2].isascii() and tail[2].isdigit() else None


def _classes(attrs: dict) -> list[str]:
    return (attrs.get("class") or "").split()


class ListingReader(HTMLParser):
    """Entries (with description) and the numbers of the section index."""

    def __init__(self, layout: Layout):
        super().__init__(convert_charrefs=True)
        self.layout = layout
        self.open: list[tuple[str, frozenset[str]]] = []     # element, what it is here
        self.count: Counter[str] = Counter()                 # open elements by name
        self.roles: Counter[str] = Counter()
        self.entries: list[_Entry] = []
        self.waiting: list[list[_Entry]] = []                # by open list: items without a description yet
        self.described: list[list[_Entry]] = []              # by open list: items whose description is open
        self.sections: list[int] = []
        self.index_item_read = False

    def _pop(self) -> None:
        tag, roles = self.open.pop()
        self.count[tag] -= 1
        self.roles.subtract(roles)
        if tag == "dl":
            self.waiting.pop()
            self.described.pop()
        elif tag == "dd" and self.described:
            self.described[-1] = []

    def _close(self, tags: tuple[str, ...], within: str) -> None:
        """Close the innermost open element of ``tags``, if none of ``within`` stands in between."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in within.split():
                return

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        attrs = dict(attributes)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        elif tag in BLOCKS:
            self._close(*CLOSES["p"])
        roles = set()
        if attrs.get("id") == self.layout.index_id:
            roles.add("index")
        if tag == "dl":
            self.waiting.append([])
            self.described.append([])
        elif tag == "dt" and self.waiting:
            entry = _Entry()
            self.entries.append(entry)
            self.waiting[-1].append(entry)
        elif tag == "dd" and self.waiting:
            self.described[-1], self.waiting[-1] = self.waiting[-1], []
            for entry in self.described[-1]:
                entry.described = True
        elif tag == "li":
            self.index_item_read = False
        elif tag == "a":
            self._link(attrs)
        if self._describing():
            found = _classes(attrs)
            if self.layout.subjects_class in found:
                roles.add("subjects")
            if self.layout.primary_class in found and self.roles["subjects"]:
                roles.add("primary")
        if tag not in VOID:
            self.open.append((tag, frozenset(roles)))
            self.count[tag] += 1
            self.roles.update(roles)

    def _link(self, attrs: dict) -> None:
        href, name = attrs.get("href"), attrs.get("name")
        if self.roles["index"] and self.count["li"] and href and not self.index_item_read:
            self.index_item_read = True
            number = _number(href, self.layout.number_prefix)
            if number is not None:
                self.sections.append(number)
        if self.waiting and self.waiting[-1] and self.count["dt"]:
            entry = self.waiting[-1][-1]
            if entry.number is None and name and name.startswith(self.layout.number_prefix):
                entry.number = _number(name, self.layout.number_prefix)
            if entry.href is None and href and attrs.get("title") == self.layout.link_title:
                entry.href = href

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not self.count[tag]:
            return
        while self.open[-1][0] != tag:
            self._pop()
        self._pop()

    def _describing(self) -> list[_Entry]:
        return self.described[-1] if self.described else []

    def handle_data(self, data: str) -> None:
        text = data.strip(BLANKS)
        if not text:
            return
        for entry in self._describing():
            entry.text.append(text)
            if self.roles["primary"]:
                entry.subjects = entry.subjects or text
            elif self.open and "subjects" in self.open[-1][1]:
                entry.other_subjects = entry.other_subjects or text


def read_page(html: str, layout: Layout) -> tuple[list[_Entry], int | None]:
    """The described, numbered and linked entries of one page in page order,
    and the last section's first number (none without a section index)."""
    reader = ListingReader(layout)
    reader.feed(html)
    reader.close()
    whole = [e for e in reader.entries if e.described and e.number is not None and e.href]
    return whole, reader.sections[-1] if reader.sections else None


def read_batches(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """The entries of batches of ``(page_id, html)``, handed on while a page is read."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for page, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            entries, cutoff = read_page(html.as_py() or "", layout)
            for i, e in enumerate(entries):
                text = " ".join(e.text)
                rows.append((page, i, e.number, e.href.rstrip("/").rpartition("/")[2], e.href, e.subjects or e.other_subjects, text, cutoff))
                held += len(text)
                if held >= OUT_CHARS:
                    yield made(rows)
                    rows, held = [], 0
        if rows:
            yield made(rows)


def listing_items(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """S14 + J8: ``pages(page_id, html)`` -> one row an entry: its place on the
    page, number, id (last part of its link), link, subjects text (null where it
    has none), description (its text nodes joined by a blank) and the page's cut-off."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(lambda batches: read_batches(batches, layout), SCHEMA)


def cut(items: DataFrame) -> DataFrame:
    """entries whose number is below the last section's start; all entries
    of a page without a section index."""
    return items.where(F.col("cutoff").isNull() | (F.col("item_no") < F.col("cutoff")))


def targeted(items: DataFrame, targets: list[str]) -> DataFrame:
    """entries with a targeted category code in their subjects, and those
    whose subjects are not known."""
    return items.where(target_overlap("subjects", targets))
