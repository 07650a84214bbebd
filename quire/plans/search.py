"""C2 search request, C3 ranked reading list, C5 keyword drill-down."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import match
from ..sources.feed import in_language


def as_terms(terms: Sequence[str] | str | None) -> list[str]:
    """P12 on a request parameter: a comma-separated text is a list of its trimmed items."""
    if isinstance(terms, str):
        terms = [t.strip() for t in terms.split(",")]
    return [t for t in terms or [] if t]


def search_request(papers: DataFrame, category: str | None = fixed.ALL_CATEGORIES,
                   keywords: Sequence[str] | str | None = None, authors: Sequence[str] | str | None = None,
                   date_from: str | None = None, date_to: str | None = None,
                   preferred: str | None = None, default: str | None = None) -> DataFrame:
    """Category AND (keyword OR author), matched rows only, with reasons.

    Terms are lists or comma-separated texts (P12); ``preferred`` and
    ``default`` choose one language variant per date (S5).

    Date bounds are plain predicates on ``date`` so a partitioned table is
    pruned to the requested days; the rest is one narrow projection.
    """
    df = papers
    if date_from:
        df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to:
        df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
    df = in_language(df, preferred, default)
    view = match.category_filter(match.search_view(df), category)
    return match.matched_only(match.match_terms(view, as_terms(keywords), as_terms(authors)))


def reading_list(papers: DataFrame, category: str | None = fixed.ALL_CATEGORIES,
                 keywords: Sequence[str] | None = None, authors: Sequence[str] | None = None,
                 text_query: str | None = None, group_cols: Sequence[str] = ("date",),
                 preferred: str | None = None, default: str | None = None) -> DataFrame:
    """Nothing is hidden; matched rows first, listing order otherwise.

    A non-empty text query takes precedence over keyword/author terms (Q11).
    """
    view = match.category_filter(match.search_view(in_language(papers, preferred, default)), category)
    if text_query and text_query.strip():
        flagged = match.match_text(view, text_query)
    elif keywords or authors:
        flagged = match.match_terms(view, keywords, authors)
    else:
        flagged = view.withColumn("is_matched", F.lit(False)).withColumn("match_reason", F.lit(None).cast("string"))
    return match.rank_reading_list(flagged, group_cols=group_cols,
                                   by_category=(category in (None, fixed.ALL_CATEGORIES)))


def keyword_drilldown(papers: DataFrame, keyword: str, date_from: str, date_to: str,
                      preferred: str | None = None, default: str | None = None) -> DataFrame:
    """Papers of a date range whose title + summary contain the keyword."""
    df = papers.where(F.col("date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    return match.drilldown(match.search_view(in_language(df, preferred, default)), keyword)
