"""Paper-record scalars: categories, authors, summary choice, URLs, code links."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import _c


def coerce_categories(raw: Column | str) -> Column:
    """A category field read as text may hold a JSON array or one scalar.

    Array text -> parsed list; scalar -> one-element list; null stays null.
    """
    r = _c(raw)
    return (F.when(r.isNull(), F.lit(None).cast("array<string>"))
            .when(F.trim(r).startswith("["), F.from_json(r, "array<string>"))
            .otherwise(F.array(r)))


def primary_category(categories: Column | str) -> Column:
    """First category; null for an empty or missing list."""
    return F.try_element_at(_c(categories), F.lit(1))


def has_category(categories: Column | str) -> Column:
    """rows without any category are not shown (no ``undefined`` bucket)."""
    p = primary_category(categories)
    return p.isNotNull() & (p != "")


def join_authors(authors: Column | str, sep: str = fixed.VIEW_AUTHOR_SEPARATOR) -> Column:
    """Author list as text; views use ', ', the digest ','."""
    return F.array_join(_c(authors), sep)


def display_summary(tldr: Column | str, abstract: Column | str) -> Column:
    """The model's tl;dr when non-empty, else the abstract."""
    return F.coalesce(F.nullif(_c(tldr), F.lit("")), _c(abstract))


def or_default(c: Column | str, default) -> Column:
    """P5: '' / null / missing all mean the default."""
    col = _c(c)
    if isinstance(default, str):
        return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))
    return F.coalesce(col, F.lit(default))


def abs_url(paper_id: Column | str) -> Column:
    """Abstract link derived from the id."""
    return F.concat(F.lit(fixed.ABS_URL_PREFIX), _c(paper_id))


def pdf_url(paper_id: Column | str) -> Column:
    """PDF link derived from the id."""
    return F.concat(F.lit(fixed.PDF_URL_PREFIX), _c(paper_id))


def reader_url(abs_link: Column | str, pdf_link: Column | str, paper_id: Column | str) -> Column:
    """Abstract link, else PDF link, else built from the id."""
    return F.coalesce(F.nullif(_c(abs_link), F.lit("")), F.nullif(_c(pdf_link), F.lit("")), abs_url(paper_id))


def swap_first_abs(url: Column | str, to: str) -> Column:
    """Replace only the *first* ``abs`` in a link (pdf / html variants)."""
    return F.regexp_replace(_c(url), r"^(.*?)abs", f"$1{to}")


def parenthesised(text: Column | str) -> Column:
    """P10: every ``(...)`` token, e.g. category codes in a subjects cell."""
    return F.regexp_extract_all(_c(text), F.lit(r"\(([^)]+)\)"), 1)


def code_url(text: Column | str) -> Column:
    """First ``github.com/owner/repo`` link, else first ``*.github.io`` page.

    Q5: only a ``.git`` suffix and trailing dots are removed (the repo pattern
    cannot end in ',' or ')'), so names such as ``toolkit`` stay whole.
    """
    t = F.coalesce(_c(text), F.lit(""))
    owner = F.regexp_extract(t, fixed.GITHUB_REPO_PATTERN, 1)
    repo = F.regexp_replace(F.regexp_extract(t, fixed.GITHUB_REPO_PATTERN, 2), r"(\.git)?\.*$", "")
    repo_url = F.when(owner != "", F.concat(F.lit(fixed.GITHUB_URL_PREFIX), owner, F.lit("/"), repo))
    pages = F.regexp_replace(F.regexp_extract(t, fixed.GITHUB_PAGES_PATTERN, 0), r"\.+$", "")
    return F.coalesce(repo_url, F.nullif(pages, F.lit("")))


def repo_owner(text: Column | str) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    return F.nullif(F.regexp_extract(t, fixed.GITHUB_REPO_PATTERN, 1), F.lit(""))


def repo_name(text: Column | str) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    r = F.regexp_replace(F.regexp_extract(t, fixed.GITHUB_REPO_PATTERN, 2), r"(\.git)?\.*$", "")
    return F.nullif(r, F.lit(""))
