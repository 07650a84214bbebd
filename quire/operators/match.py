"""Search and ranking over papers: category filter, keyword / author / text
matching with match reasons, term tables, match-first reading lists.

Matching is case-insensitive substring search.  A literal term list becomes
one ``contains`` per term inside a single projection (whole-stage codegen, no
shuffle, no Python).  A term *table* (J5/J7) of any size is matched by one
plan: each distinct term is keyed by one of its runs of bytes (its seed),
texts offer those of their runs that a bitmap of all seeds lets through, an
equi-join on the seed gives candidates, and ``contains`` verifies them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.papers import display_summary, join_authors, or_default, primary_category, reader_url
from ..functions.text import haystack
from . import seeds
from .numbering import number_rows


#: P5: what a paper without code facts shows.
CODE_DEFAULTS = {"code_url": "", "code_stars": 0, "code_last_update": ""}


def search_view(papers: DataFrame) -> DataFrame:
    """What searches see.  ``summary`` is the tl;dr when present, else
    the abstract; ``details`` the abstract; authors joined with ', '."""
    cols = set(papers.columns)
    ai = F.col("AI") if "AI" in cols else None

    def ai_field(f: str) -> Column:
        return F.coalesce(ai.getField(f), F.lit("")) if ai is not None else F.lit("")

    tldr = ai.getField("tldr") if ai is not None else F.lit(None).cast("string")
    authors = join_authors("authors") if dict(papers.dtypes).get("authors", "").startswith("array") \
        else F.col("authors")
    pdf = F.col("pdf") if "pdf" in cols else F.lit(None).cast("string")
    abs_ = F.col("abs") if "abs" in cols else F.lit(None).cast("string")
    # Without a recorded listing order, rows order by id (seq 0 for all).
    seq = F.col("seq") if "seq" in cols else F.lit(0).cast("long")
    return papers.select(
        F.col("id"), seq.alias("seq"), F.col("date"),
        F.col("title"),
        reader_url(abs_, pdf, F.col("id")).alias("url"),
        authors.alias("authors"),
        F.col("categories"),
        (F.col("primary_category") if "primary_category" in cols
         else primary_category("categories")).alias("primary_category"),
        display_summary(tldr, F.col("summary")).alias("summary"),
        F.coalesce(F.col("summary"), F.lit("")).alias("details"),
        *[ai_field(f).alias(f) for f in ("motivation", "method", "result", "conclusion")],
        *[(or_default(c, d) if c in cols else F.lit(d)).alias(c) for c, d in CODE_DEFAULTS.items()],
        *[F.col(c) for c in ("language",) if c in cols],
    )


def category_filter(df: DataFrame, category: str | None) -> DataFrame:
    """by primary category; ``all`` (or None) keeps everything."""
    if category is None or category == fixed.ALL_CATEGORIES:
        return df
    return df.where(F.col("primary_category") == F.lit(category))


def _lower_lit(t: str) -> Column:
    # Lower-cased by the same JVM function that lower-cases the haystack.
    return F.lower(F.lit(t))


def literal_hits(hay: Column, terms: Sequence[str]) -> Column:
    """The distinct terms (original spelling, list order) contained in ``hay``.

    ``hay`` must already be lower-case.  Built from ``CASE`` expressions and
    ``array_except`` (drops the nulls of non-hits), which keeps the projection
    inside whole-stage code generation; no higher-order function.
    """
    if not terms:
        return F.array().cast("array<string>")
    return F.array_except(F.array(*[F.when(hay.contains(_lower_lit(t)), F.lit(t)) for t in terms]),
                          F.array(F.lit(None).cast("string")))


def any_hit(hay: Column, terms: Sequence[str]) -> Column:
    """True when ``hay`` (lower-case) contains any term: a short-circuit OR of ``contains``."""
    if not terms:
        return F.lit(False)
    c = None
    for t in terms:
        x = hay.contains(_lower_lit(t))
        c = x if c is None else (c | x)
    return c


def hit_text(hay: Column, terms: Sequence[str]) -> Column:
    """The hit terms joined with ', ' ('' when none); no arrays involved."""
    if not terms:
        return F.lit("")
    return F.concat_ws(fixed.REASON_TERM_SEPARATOR, *[F.when(hay.contains(_lower_lit(t)), F.lit(t)) for t in terms])


def keyword_haystack() -> Column:
    """keywords are searched in title + ' ' + displayed summary."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("summary"), F.lit(""))))


def author_haystack() -> Column:
    """authors are searched in the joined author text."""
    return F.lower(F.coalesce(F.col("authors"), F.lit("")))


def text_haystack() -> Column:
    """Nine fields joined and lower-cased."""
    return haystack("title", "authors", F.array_join("categories", ", "), "summary", "details",
                    "motivation", "method", "result", "conclusion")


def _reason(prefix: str, hits: Column) -> Column:
    return F.when(hits != "", F.concat(F.lit(prefix), hits))


def match_terms(df: DataFrame, keywords: Sequence[str] | None = None,
                authors: Sequence[str] | None = None) -> DataFrame:
    """F4-F6 + P15: ``is_matched`` = any keyword OR any author hit.

    A missing or empty list is *no condition* of that kind; with no terms at
    all every row matches (Q1: the documented rule).  ``match_reason`` lists
    the hits per kind, joined with `` | ``; NULL when nothing hit.

    The flag is a plain OR of ``contains`` so a filter on it stays cheap when
    the optimizer pushes it down to the scan; the reason is only computed
    for the rows that reach the final projection.
    """
    keywords = [k for k in (keywords or []) if k]
    authors = [a for a in (authors or []) if a]
    kh, ah = keyword_haystack(), author_haystack()
    matched = F.lit(True) if not keywords and not authors else (any_hit(kh, keywords) | any_hit(ah, authors))
    reason = F.nullif(F.concat_ws(fixed.REASON_KIND_SEPARATOR,
                                  _reason(fixed.KEYWORD_REASON_PREFIX, hit_text(kh, keywords)),
                                  _reason(fixed.AUTHOR_REASON_PREFIX, hit_text(ah, authors))), F.lit(""))
    return df.withColumn("is_matched", matched).withColumn("match_reason", reason)


def match_text(df: DataFrame, query: str | None) -> DataFrame:
    """free-text query over nine fields; reason ``文本: <query>``.

    An empty query matches nothing and leaves keyword/author flags alone (the
    caller decides precedence, Q11: text search wins when present).
    """
    if not query or not query.strip():
        return df.withColumn("is_matched", F.lit(False)).withColumn("match_reason", F.lit(None).cast("string"))
    hit = text_haystack().contains(_lower_lit(query))
    return (df.withColumn("is_matched", hit)
            .withColumn("match_reason", F.when(hit, F.lit(fixed.TEXT_REASON_PREFIX + query))))


def matched_only(df: DataFrame) -> DataFrame:
    """F8: response mode keeps only matched rows."""
    return df.where(F.col("is_matched"))


def drilldown(df: DataFrame, keyword: str) -> DataFrame:
    """rows whose title + summary contain the keyword."""
    return df.where(keyword_haystack().contains(_lower_lit(keyword)))


def _distinct_terms(terms: DataFrame, term_col: str) -> DataFrame:
    return terms.select(F.col(term_col).alias("term")).where(F.col("term").isNotNull() & (F.col("term") != "")).distinct()


def term_hits(df: DataFrame, terms: DataFrame, hay: Column, key: str = "id",
              term_col: str = "term") -> DataFrame:
    """(key, term) for every row whose haystack contains a term.

    Distinct terms are matched once, case-insensitively (lower-cased on the
    JVM like the haystack).  One seed a term (``seeds.py``) stands for it; a
    bitmap of the seeds is tested over the texts' bytes, so only runs that may
    be a seed become rows, and the candidates that meet a term on an equal seed
    are verified with ``contains`` (a term that is its own seed needs none).  A
    term table within a measured size is sent to the texts, and no text moves;
    beyond it only (key, seed) pairs are shuffled and the texts are joined back
    by key and verified there, as a key may repeat.
    """
    dterms = _distinct_terms(terms, term_col).select("term", F.lower("term").alias("lt"))
    seeded = seeds.seeded_terms(dterms)
    table = seeds.SeedTable.of(seeded)
    base = df.select(F.col(key), hay.alias("_hay")).where(F.col(key).isNotNull())
    if not table.lengths:
        return base.where("false").select(key, F.lit("").alias("term"))
    candidates = F.explode(table.runs(F.col("_hay"))).alias("_seed")
    if table.small:
        near = base.select(key, "_hay", candidates).join(F.broadcast(seeded), "_seed")
        return near.where(seeds.is_whole("lt") | F.col("_hay").contains(F.col("lt"))).select(key, "term")
    pairs = base.select(key, candidates).join(seeded, "_seed").select(key, "term", "lt").distinct()
    return base.join(pairs, key).where(F.col("_hay").contains(F.col("lt"))).select(key, "term")


HAYSTACKS = (("keyword", keyword_haystack), ("author", author_haystack))


def preference_counts(df: DataFrame, preferences: DataFrame, key: str = "id") -> DataFrame:
    """Each stored preference ``(user_id, kind, term)`` with the number of
    papers that it matches: one row per preference.

    Terms of all users are matched once (J5 over distinct terms) and counted
    per term before they meet the users, so a popular term never multiplies
    its papers by its users.
    """
    out = None
    for kind, hay in HAYSTACKS:
        p = preferences.where(F.col("kind") == kind).select("user_id", "kind", "term")
        n = term_hits(df, p, hay(), key=key).groupBy("term").agg(F.count(F.lit(1)).alias("n_papers"))
        j = p.join(n, "term", "left").select("user_id", "kind", "term", F.coalesce("n_papers", F.lit(0)).alias("n_papers"))
        out = j if out is None else out.unionByName(j)
    return out


def preference_hits(df: DataFrame, preferences: DataFrame, user_id, key: str = "id") -> DataFrame:
    """J7 for one user: ``(user_id, key, kind, term)`` of the papers that the
    user's stored terms match (a reading list of at most papers x own terms)."""
    own = preferences.where(F.col("user_id") == F.lit(user_id))
    out = None
    for kind, hay in HAYSTACKS:
        hits = term_hits(df, own.where(F.col("kind") == kind), hay(), key=key)
        j = hits.select(F.lit(user_id).alias("user_id"), key, F.lit(kind).alias("kind"), "term")
        out = j if out is None else out.unionByName(j)
    return out


def preference_export(prefs: DataFrame, sep: str = ",") -> DataFrame:
    """Each user's list per kind, duplicates removed, in the order terms
    were added (``pos``; term order when absent), joined with ``sep``.

    A user's list is small and bounded, so it is gathered per (user, kind).
    """
    pos = F.col("pos") if "pos" in prefs.columns else F.lit(0)
    d = (prefs.where(F.col("term").isNotNull() & (F.trim("term") != ""))
         .withColumn("term", F.trim("term"))
         .groupBy("user_id", "kind", "term").agg(F.min(pos).alias("_pos")))
    g = d.groupBy("user_id", "kind").agg(F.array_sort(F.collect_list(F.struct("_pos", "term"))).alias("_l"))
    return g.select("user_id", "kind", F.array_join(F.transform("_l", lambda x: x.getField("term")), sep)
                    .alias("terms"))


def rank_reading_list(df: DataFrame, group_cols: Sequence[str] = ("date",),
                      by_category: bool = True, num_partitions: int | None = None) -> DataFrame:
    """O3 + W3 + W6: matched rows first, otherwise the listing order.

    The listing order is category (when the list spans categories) then
    ``seq``; Spark sorts are not stable, so ``seq`` is the explicit tie-break.
    Adds ``rank`` (1-based within each group) and ``n`` (group size);
    numbering is skew-safe (see ``numbering``).
    """
    order = [~F.col("is_matched")]
    if by_category:
        # O1's order: the collation that lists and digests use, then by name.
        order += [F.collate(F.col("primary_category"), "UNICODE"), F.col("primary_category")]
    order += [F.col("seq"), F.col("id")]
    return number_rows(df, order, group_cols, name="rank", size_name="n", num_partitions=num_partitions)


def position_text(rank: Column | str = "rank", n: Column | str = "n") -> Column:
    """``i / n``."""
    return F.concat(F.col(rank).cast("string") if isinstance(rank, str) else rank.cast("string"),
                    F.lit(" / "), F.col(n).cast("string") if isinstance(n, str) else n.cast("string"))


def circular_neighbours(ranked: DataFrame, group_cols: Sequence[str] = ("date",), key: str = "id") -> DataFrame:
    """Previous / next item in the ranked list, wrapping at both ends.

    Two equi-joins on ``(group, rank)``, which is unique, so repeated or null
    ids neither multiply nor vanish; no window funnels a hot group into one task.
    """
    g = list(group_cols)
    prev_rank = F.when(F.col("rank") > 1, F.col("rank") - 1).otherwise(F.col("n"))
    next_rank = F.when(F.col("rank") < F.col("n"), F.col("rank") + 1).otherwise(F.lit(1).cast("long"))
    out = ranked.select(*g, key, "rank", "n", prev_rank.alias("_pr"), next_rank.alias("_nr"))
    for rank, name in (("_pr", "prev_id"), ("_nr", "next_id")):
        look = ranked.select(*[F.col(c).alias(f"_lg{i}") for i, c in enumerate(g)],
                             F.col("rank").alias("_lr"), F.col(key).alias(name))
        cond = [F.col(rank) == F.col("_lr")] + [F.col(c).eqNullSafe(F.col(f"_lg{i}")) for i, c in enumerate(g)]
        out = out.join(look, cond, "left").drop(rank, "_lr", *[f"_lg{i}" for i in range(len(g))])
    return out


def response_parts(df: DataFrame, category: str, keywords: Sequence[str] | None,
                   authors: Sequence[str] | None, group_cols: Sequence[str] = ("date",)) -> DataFrame:
    """The JSON answer of a search request as ordered parts, one group per day.

    ``part = 0`` is the header object ``{category, author, keywords, count}``
    (count from an aggregate); ``part = 1`` rows are the papers
    ``{id, title, authors, categories, summary, date, url, reason}`` with
    their position ``pos`` in the answer: by category, then listing order when
    the request spans categories, else by listing order.  A writer emits the header with
    a ``papers`` array of the part-1 rows in ``pos`` order; no day is ever
    gathered into a single row, however many papers match.
    """
    kw = F.array(*[F.lit(k) for k in keywords]) if keywords else F.lit(None).cast("array<string>")
    au = F.array(*[F.lit(a) for a in authors]) if authors else F.lit(None).cast("array<string>")
    g = list(group_cols)
    keep_nulls = {"ignoreNullFields": "false"}     # absent author / reason appear as null
    head = df.groupBy(*g).agg(F.count(F.lit(1)).alias("count")).select(
        *g, F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"),
        F.to_json(F.struct(F.lit(category).alias("category"), au.alias("author"), kw.alias("keywords"),
                           F.col("count")), keep_nulls).alias("json"))
    order = [F.col("seq"), F.col("id")]
    if category in (None, fixed.ALL_CATEGORIES):
        order = [F.collate(F.col("primary_category"), "UNICODE"), F.col("primary_category"), *order]
    placed = number_rows(df, order, g, name="pos")
    papers = placed.select(*g, F.lit(1).alias("part"), "pos", F.to_json(F.struct(
        "id", "title", "authors", "categories", "summary", F.date_format("date", "yyyy-MM-dd").alias("date"),
        "url", F.col("match_reason").alias("reason")), keep_nulls).alias("json"))
    return head.unionByName(papers)


def response_document(parts: DataFrame) -> str:
    """Assemble one small response (a single request's day) on the driver.

    For interactive use only: it collects the parts of *one* group; large
    answers should be written from ``response_parts`` instead.
    """
    rows = sorted(parts.select("part", "pos", "json").collect(), key=lambda r: (r["part"], r["pos"]))
    head = rows[0]["json"][:-1] if rows else "{"
    papers = ",".join(r["json"] for r in rows[1:])
    return f'{head},"papers":[{papers}]}}'
