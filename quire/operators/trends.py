"""Keyword statistics over titles (C4): candidates, top terms per title,
frequencies, top-k, per-day trend series and the dense keyword x date grid.

Candidate extraction (M4, default without a tagger)
---------------------------------------------------
1. P13: non-word characters -> space, whitespace collapsed, trimmed; lower-case.
2. Break words end a run: the function words of the stop list and every word
   of at most two letters (stand-ins for determiners and pronouns).  Each
   maximal run of other words is one candidate.  This is a stated deviation
   from a part-of-speech tagger: verbs and other non-nouns can enter runs.
3. Runs longer than three words give no candidate.
4. F16: every word longer than two letters, not all words stop words.
Per title: a candidate weighs 1, a phrase 1.5, divided by the title total
(A8); the 10 heaviest are kept, ties by first position (W2).

Everything per title is array functions in one narrow projection; the only
shuffles are the (keyword[, date]) aggregations, with partial aggregation
map-side.  A user tagger can replace step 2 via ``candidates_from_tags``.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import cloud_weight, normalize_title
from ..session import materialize
from ..sources.feed import in_language

# Function words of the stop list that break candidate runs: those that open
# it, before its first noun, and the prepositions among the others.
BREAK_WORDS = [*fixed.STOP_WORDS[:fixed.STOP_WORDS.index("method")], "via", "using", "from", "towards"]
BREAK_PATTERN = r"\b(" + "|".join(BREAK_WORDS) + r")\b|\b\w{1,2}\b"


def title_candidates(title: Column | str) -> Column:
    """M4 steps 1-4: distinct candidate terms of a title, in first-seen order."""
    norm = F.lower(normalize_title(title))
    runs = F.split(F.regexp_replace(norm, BREAK_PATTERN, "|"), r"\|")
    runs = F.filter(F.transform(runs, lambda r: F.trim(F.regexp_replace(r, r"\s+", " "))), lambda r: r != "")
    stop = F.array(*[F.lit(w) for w in fixed.STOP_WORDS])

    def keep(r: Column) -> Column:
        ws = F.split(r, " ")
        return ((F.size(ws) <= fixed.MAX_PHRASE_WORDS)
                & F.forall(ws, lambda w: F.length(w) >= fixed.MIN_WORD_CHARS)
                & ~F.forall(ws, lambda w: F.array_contains(stop, w)))

    return F.array_distinct(F.filter(runs, keep))


def top_terms(cands: Column | str, k: int = fixed.TERMS_PER_TITLE) -> Column:
    """A8 + W2: the ``k`` heaviest candidates (phrases 1.5, words 1; ties by position)."""
    c = F.col(cands) if isinstance(cands, str) else cands
    keyed = F.transform(c, lambda x, i: F.struct(
        F.when(F.instr(x, " ") > 0, F.lit(0)).otherwise(F.lit(1)).alias("single"), i.alias("pos"), x.alias("term")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s.getField("term"))


def term_weights(cands: Column | str) -> Column:
    """``array<struct<term, weight>>`` with weight = w / sum(w)."""
    c = F.col(cands) if isinstance(cands, str) else cands

    def weight(x: Column) -> Column:
        return F.when(F.instr(x, " ") > 0, F.lit(fixed.PHRASE_WEIGHT)).otherwise(F.lit(1.0))

    def weighed(terms: Column) -> Column:
        total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + weight(x))
        return _once(total, lambda t: F.transform(terms, lambda x: F.struct(x.alias("term"), (weight(x) / t).alias("weight"))))

    return _once(c, weighed)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value found once, however often it is used (an
    expression that stands inside a lambda is found anew for every element)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def title_keywords(papers: DataFrame, title_col: str = "title") -> DataFrame:
    """``(id, date, keyword)``: at most one row per keyword and title."""
    return papers.select("id", "date", F.explode(top_terms(title_candidates(title_col))).alias("keyword"))


def keyword_counts(kw: DataFrame) -> DataFrame:
    """A3 + F17: titles per keyword, keywords seen more than once."""
    return kw.groupBy("keyword").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def keyword_day_counts(kw: DataFrame) -> DataFrame:
    """A4: titles per (date, keyword); the real date of each title (Q2)."""
    return kw.groupBy("date", "keyword").agg(F.count(F.lit(1)).alias("count"))


def top_keywords(counts: DataFrame, k: int = fixed.CLOUD_TOP) -> DataFrame:
    """O5 + P17: the ``k`` most frequent keywords, ties by keyword; rank and cloud size.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k, the driver merges ``k x tasks`` rows.
    """
    top = counts.orderBy(F.col("count").desc(), F.col("keyword").asc()).limit(k)
    # k rows: ranking them needs no skew care.
    from pyspark.sql import Window
    w = Window.orderBy(F.col("count").desc(), F.col("keyword").asc())
    return top.select("keyword", "count", F.row_number().over(w).cast("long").alias("rank"),
                      cloud_weight("count").alias("size"))


def trend_grid(day_counts: DataFrame, top: DataFrame, dates: DataFrame, k: int = fixed.TREND_TOP) -> DataFrame:
    """O6 + J6 + O7: every top-``k`` keyword on every date of the range, 0 when absent.

    ``day_counts`` is ``(date, keyword, count)`` (A4).  The top ``k``
    keywords (``k`` rows at most) are read as a list and exploded over the
    distinct dates, so the grid needs no join of its own; the day counts of
    those keywords are then left-joined on ``(keyword, date)``.
    """
    keys = [r["keyword"] for r in top.where(F.col("rank") <= k).orderBy("rank").collect()]   # <= k rows
    kws = F.array(*[F.lit(x) for x in keys]) if keys else F.array().cast("array<string>")
    grid = dates.select("date").distinct().select("date", F.explode(kws).alias("keyword"))
    counts = day_counts.where(F.col("keyword").isin(keys)) if keys else day_counts.limit(0)
    return (grid.join(counts, ["keyword", "date"], "left")
            .select("keyword", "date", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def chronological(grid: DataFrame) -> DataFrame:
    """Each keyword's series in date order (a sort for presentation: a grid
    has at most ``k`` x dates rows)."""
    return grid.orderBy("keyword", "date")


def trend_extent(grid: DataFrame) -> DataFrame:
    """A10: peak count and date extent per keyword series."""
    return grid.groupBy("keyword").agg(F.max("count").alias("peak"), F.min("date").alias("first_date"),
                                       F.max("date").alias("last_date"))


def candidates_from_tags(tokens: Column | str, tags: Column | str) -> Column:
    """M4 with a user tagger: noun runs and adjective+noun runs (<= 3 words).

    ``tags`` holds one tag per token (``NOUN`` / ``ADJ`` / other).  A run is a
    maximal sequence of NOUN / ADJ tokens; its nouns alone and the whole run
    are candidates.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    g = F.col(tags) if isinstance(tags, str) else tags
    marked = F.transform(F.arrays_zip(t.alias("tok"), g.alias("tag")), lambda z: F.when(
        z.getField("tag").isin("NOUN", "ADJ"), F.concat(z.getField("tag"), F.lit(":"), z.getField("tok")))
        .otherwise(F.lit("|")))
    runs = F.filter(F.transform(F.split(F.array_join(marked, " "), r"\|"), lambda r: F.trim(r)), lambda r: r != "")

    def run_terms(r: Column) -> Column:
        ws = F.split(r, " ")
        nouns = F.filter(ws, lambda w: w.startswith("NOUN:"))
        strip = lambda a: F.array_join(F.transform(a, lambda w: F.regexp_replace(w, r"^[A-Z]+:", "")), " ")
        return F.array(strip(nouns), strip(ws))

    terms = F.flatten(F.transform(runs, run_terms))
    return F.array_distinct(F.filter(terms, lambda x: (x != "") & (F.size(F.split(x, " ")) <= fixed.MAX_PHRASE_WORDS)))


def keyword_statistics(papers: DataFrame, date_from: str | None = None, date_to: str | None = None,
                       k_cloud: int = fixed.CLOUD_TOP, k_trend: int = fixed.TREND_TOP, preferred: str | None = None,
                       default: str | None = None, listed: DataFrame | None = None) -> dict[str, DataFrame]:
    """C4: cloud (top keywords) and trend grid over a date range.

    With ``preferred`` each day is counted in one language variant (S5): the
    preferred, else the default, else the first listed (``feed.in_language``)."""
    df = in_language(papers, preferred, default, listed)
    if date_from:
        df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to:
        df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
    kw = title_keywords(df)
    # Keywords are extracted once: the per-day counts (a small aggregate) are
    # checkpointed, totals are their sums, and the cloud and the grid read them.
    day = materialize(keyword_day_counts(kw))
    totals = day.groupBy("keyword").agg(F.sum("count").alias("count")).where(F.col("count") > 1)
    top = top_keywords(totals, k_cloud)
    grid = trend_grid(day, top, df.select("date"), k_trend)
    return {"keywords": kw, "day_counts": day, "cloud": top, "trend": grid}
