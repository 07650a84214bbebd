"""Text scalars: cleaning, normalisation, haystacks, highlighting, authors, dates."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ASCII whitespace removed by a text node's strip().
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c: Column | str) -> Column:
    return F.trim(_c(c), F.lit(WHITESPACE))


def clean_pieces(pieces: Column | str) -> Column:
    """Strip every text piece, drop blank ones, join with one space."""
    return F.array_join(F.filter(F.transform(_c(pieces), lambda x: strip_ws(x)), lambda x: x != ""), " ")


def strip_descriptor(text: Column | str, descriptor: str) -> Column:
    """Drop a leading label such as ``Title:`` and strip what follows."""
    t = strip_ws(text)
    return F.when(t.startswith(descriptor), strip_ws(F.substring(t, len(descriptor) + 1, 1 << 30))).otherwise(t)


def csv_terms(param: Column | str) -> Column:
    """``a, b,,c`` -> [a, b, c]; null stays null (no condition)."""
    return F.filter(F.transform(F.split(_c(param), ","), lambda x: F.trim(x)), lambda x: x != "")


def normalize_title(title: Column | str) -> Column:
    """Every non-word character becomes a space, runs collapse, ends trimmed.

    ``\\w`` is ASCII in Java regex, matching the browser's regex without the
    unicode flag, so accented letters are separators in both.
    """
    t = F.regexp_replace(F.coalesce(_c(title), F.lit("")), r"[^\w\s]", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def haystack(*parts: Column | str) -> Column:
    """Fields joined by one space and lower-cased; a missing field is ''
    (an array join in the browser prints null as empty, keeping the separator)."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(_c(p), F.lit("")) for p in parts]))


def js_regex_escape(term: str) -> str:
    """Escape the characters a browser escapes before building a term regex."""
    return re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", term)


def highlight(text: Column | str, terms: Sequence[str], css_class: str = fixed.HIGHLIGHT_CLASS) -> Column:
    """Wrap every case-insensitive hit of any term in a span.

    One alternation, longest term first, so markup inserted for one term is
    never rewritten by another (Q10).
    """
    terms = [t for t in terms if t]
    if not terms:
        return _c(text)
    alts = "|".join(js_regex_escape(t) for t in sorted(terms, key=len, reverse=True))
    return F.regexp_replace(_c(text), f"(?iu)({alts})", f'<span class="{css_class}">$1</span>')


def author_list(authors_text: Column | str) -> Column:
    """Split a joined author string back into trimmed, non-empty names."""
    return F.filter(F.transform(F.split(_c(authors_text), ","), lambda x: F.trim(x)), lambda x: x != "")


def abbreviate_authors(authors_text: Column | str) -> Column:
    """Up to 4 names in full; more: first 2, an ellipsis, last 2."""
    a = author_list(authors_text)
    short = F.concat(F.slice(a, 1, fixed.AUTHORS_HEAD), F.array(F.lit(fixed.AUTHOR_ELLIPSIS)),
                     F.slice(a, -fixed.AUTHORS_TAIL, fixed.AUTHORS_TAIL))
    shown = F.when(F.size(a) <= fixed.AUTHORS_SHOWN_IN_FULL, a).otherwise(short)
    return F.when(_c(authors_text).isNull(), F.lit("")).otherwise(F.array_join(shown, ", "))


def display_date(d: Column | str) -> Column:
    """``M/D/YYYY`` as the reader shows it."""
    return F.date_format(_c(d), "M/d/yyyy")


def iso_date(d: Column | str) -> Column:
    """``YYYY-MM-DD`` key used in file names and comparisons."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def cloud_weight(count: Column | str) -> Column:
    """clamp(count * 3, 12, 50)."""
    return F.greatest(F.lit(fixed.CLOUD_MIN_SIZE),
                      F.least(F.lit(fixed.CLOUD_MAX_SIZE), _c(count) * fixed.CLOUD_FACTOR)).cast("long")


def render(template: str, **slots: Column | str) -> Column:
    """Fill ``{name}`` slots of a fixed template with column values.

    The template is split on its slots at plan time; the row work is one
    ``concat`` (a null slot renders as empty text).
    """
    parts = re.split(r"\{(\w+)\}", template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            cols.append(F.coalesce(_c(slots[p]).cast("string"), F.lit("")))
    return F.concat(*cols) if cols else F.lit("")
