"""Extraction from raw pages (S14, S15) plus the listing rules that go with
them (F1 target-category overlap, F2 listing cut-off, J8 entry pairing).

Crawling is not part of this package: input is a table ``pages(page_id, url,
html)``.  Field extraction for simple, fixed tags uses built-in regular
expressions (S15: JVM-side, no Python).  Listing extraction that needs a real
HTML tokenizer (S14) runs the standard library parser inside
``mapInPandas``, one Arrow batch at a time; Spark partitions the pages.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.papers import abs_url, parenthesised, pdf_url
from ..functions.text import clean_pieces, strip_descriptor

# --- fixed values: HTML entities decoded in extracted text -----------------
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def unescape(c: Column) -> Column:
    """Decode the common named entities (``&amp;`` last, so it is not decoded twice)."""
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def inner(html: Column | str, tag: str) -> Column:
    """Inner HTML of the first ``<tag ...>...</tag>``; '' when absent."""
    h = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract(h, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def text_of(fragment: Column) -> Column:
    """Text nodes of a fragment, each trimmed, blanks dropped, joined by one space."""
    return clean_pieces(F.transform(F.split(fragment, r"<[^>]*>"), lambda p: unescape(p)))


def page_record(pages: DataFrame, descriptor_title: str = "Title:",
                descriptor_summary: str = "Abstract:") -> DataFrame:
    """One record per page: title (from ``h1``), summary (article text
    without its heading), language (``html lang``), links (``nav`` hrefs)."""
    art = inner("html", "article")
    body = F.regexp_replace(art, r"(?s)<h1(?:\s[^>]*)?>.*?</h1>", "")
    return pages.select(
        "page_id", "url",
        strip_descriptor(text_of(inner("html", "h1")), descriptor_title).alias("title"),
        strip_descriptor(text_of(body), descriptor_summary).alias("summary"),
        F.nullif(F.regexp_extract("html", r'<html[^>]*\slang="([^"]*)"', 1), F.lit("")).alias("lang"),
        F.regexp_extract_all(inner("html", "nav"), F.lit(r'href="([^"]*)"'), 1).alias("links"),
    )


def section_paragraphs(pages: DataFrame) -> DataFrame:
    """``(page_id, paragraphs)``: the article split at each ``<p>`` (first piece dropped)."""
    art = inner("html", "article")
    ps = F.split(art, "<p>")
    return pages.select("page_id", F.slice(ps, 2, 1 << 30).alias("paragraphs"))


def listing_cutoff(items: Column | str, is_anchor) -> Column:
    """keep the items before the start of the last section.

    ``is_anchor(item)`` marks items that start a section; with no anchor the
    whole list is kept.  Works on the page's array in place (no shuffle).
    """
    arr = F.col(items) if isinstance(items, str) else items
    starts = F.filter(F.transform(arr, lambda x, i: F.when(is_anchor(x), i)), lambda i: i.isNotNull())
    cut = F.array_max(starts)
    return F.when(cut.isNull(), arr).otherwise(F.slice(arr, 1, cut))


def target_overlap(subjects_text: Column | str, targets: Sequence[str]) -> Column:
    """keep a row when its subjects text has a targeted code in
    parentheses; a row without a subjects text is kept, a text without any
    targeted code is not."""
    t = F.col(subjects_text) if isinstance(subjects_text, str) else subjects_text
    hit = F.arrays_overlap(subject_codes(t), F.array(*[F.lit(x) for x in targets]))
    return F.when(F.coalesce(F.trim(t), F.lit("")) == "", True).otherwise(F.coalesce(hit, F.lit(False)))


def subject_codes(subjects_text: Column | str) -> Column:
    """P10: category codes in parentheses of a subjects cell."""
    return parenthesised(subjects_text)


# --- S14: listing pages through a real HTML tokenizer ----------------------
LISTING_SCHEMA = "page_id long, pos int, tag string, href string, name string, text string"


def _listing_batches(batches: Iterator[pd.DataFrame], tags: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    from html.parser import HTMLParser

    class Collector(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.rows, self.stack = [], []

        def handle_starttag(self, tag, attrs):
            if tag in tags:
                a = dict(attrs)
                self.stack.append([tag, a.get("href"), a.get("name"), []])

        def handle_endtag(self, tag):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    t, href, name, txt = self.stack.pop(i)
                    self.rows.append((t, href, name, " ".join(s.strip() for s in txt if s.strip())))
                    break

        def handle_data(self, data):
            for entry in self.stack:
                entry[3].append(data)

    for pdf in batches:
        out = []
        for pid, html in zip(pdf["page_id"], pdf["html"]):
            c = Collector()
            c.feed(html or "")
            c.close()
            out.extend((pid, i, *r) for i, r in enumerate(c.rows))
        yield pd.DataFrame(out, columns=["page_id", "pos", "tag", "href", "name", "text"])


def listing_entries(pages: DataFrame, tags: Sequence[str] = ("a", "dt", "dd", "li")) -> DataFrame:
    """Every element of the given tags with its attributes and text, in
    document order (``pos`` = closing order within the page)."""
    t = tuple(tags)
    return pages.select("page_id", "html").mapInPandas(lambda it: _listing_batches(it, t), LISTING_SCHEMA)


def pair_entries(entries: DataFrame, first_tag: str = "dt", second_tag: str = "dd") -> DataFrame:
    """Each ``first_tag`` entry with the ``second_tag`` entry that follows it.

    ``lead`` over one page's entries (a page is a bounded group).
    """
    from pyspark.sql import Window
    w = Window.partitionBy("page_id").orderBy("pos")
    e = entries.where(F.col("tag").isin(first_tag, second_tag))
    e = e.withColumn("_next_tag", F.lead("tag").over(w)).withColumn("_next_text", F.lead("text").over(w))
    return e.where((F.col("tag") == first_tag) & (F.col("_next_tag") == second_tag)).select(
        "page_id", "pos", F.col("text").alias("entry"), F.col("_next_text").alias("description"))


def _by_class(tag: str, cls: str) -> str:
    return rf'(?s)<{tag}[^>]*class="[^"]*\b{cls}\b[^"]*"[^>]*>(.*?)</{tag}>'


def abstract_record(pages: DataFrame, fallback_categories: Column | None = None) -> DataFrame:
    """S15 for abstract pages: id (last part of the URL), the links derived from
    it (P1), title, authors in order, abstract, comment and categories (codes
    in parentheses of the subjects cell, else ``fallback_categories`` from the
    listing)."""
    h = F.col("html")
    authors_html = F.regexp_extract(h, _by_class("div", "authors"), 1)
    names = F.regexp_extract_all(authors_html, F.lit(r"(?s)<a[^>]*>(.*?)</a>"), 1)
    authors = F.filter(F.transform(names, lambda n: F.trim(unescape(F.regexp_replace(n, r"<[^>]*>", "")),
                                                          F.lit(" \t\n\r\x0b\x0c"))), lambda n: n != "")
    comment_html = F.regexp_extract(
        h, r'(?s)<td[^>]*class="[^"]*\blabel\b[^"]*"[^>]*>\s*Comments:\s*</td>\s*<td[^>]*>(.*?)</td>', 1)
    subjects = text_of(F.regexp_extract(h, _by_class("td", "subjects"), 1))
    cats = subject_codes(subjects)
    if fallback_categories is not None:
        cats = F.when(F.size(cats) > 0, cats).otherwise(fallback_categories)
    page_id = F.element_at(F.split(F.regexp_replace("url", r"/+$", ""), "/"), -1)
    return pages.select(
        page_id.alias("id"), pdf_url(page_id).alias("pdf"), abs_url(page_id).alias("abs"),
        strip_descriptor(text_of(F.regexp_extract(h, _by_class("h1", "title"), 1)), "Title:").alias("title"),
        authors.alias("authors"),
        strip_descriptor(text_of(F.regexp_extract(h, _by_class("blockquote", "abstract"), 1)), "Abstract:")
        .alias("summary"),
        text_of(comment_html).alias("comment"),
        cats.alias("categories"),
    )
