"""Checked queries: search, matching, ranking (F3-F9, J5, J7, O3, W3, W5, W6,
P1-P8, P12, P14, P15, S13)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import papers as pf
from ..functions import text as tf
from ..operators import match
from ..session import apply_confs
from ..sources.tables import load_table, papers_view
from . import search
from .oracle_views import PAPERS, with_
from .registry import register

# Search parameters of the checked queries.
KEYWORDS = ["ouen", "Eaux", "nicht", "the by"]
AUTHORS = ["Author 1", "author 36"]
TEXT_QUERY = "0 src1"
DRILL_KEYWORD = "tion"
DRILL_FROM, DRILL_TO = "2024-01-05", "2024-01-12"
CATEGORY = "src3"
# Keyword terms of the derived preference table, chosen by customer key.
PREF_WORDS = ["ouen", "eaux", "nicht", "zz", "über"]


def _papers(spark, sf_dir):
    apply_confs(spark)
    return papers_view(load_table(spark, sf_dir, "documents"))


def _sql_list(vals):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def _hits_sql(hay: str, terms, prefix: str) -> str:
    parts = ", ".join(f"CASE WHEN contains({hay}, lower('{t}')) THEN '{t}' END" for t in terms)
    return f"CASE WHEN concat_ws(', ', {parts}) <> '' THEN concat('{prefix}', concat_ws(', ', {parts})) END"


KW_HAY = "lower(concat_ws(' ', coalesce(title, ''), coalesce(summary, '')))"
AU_HAY = "lower(coalesce(authors, ''))"
KW_ANY = " OR ".join(f"contains({KW_HAY}, lower('{t}'))" for t in KEYWORDS)
AU_ANY = " OR ".join(f"contains({AU_HAY}, lower('{t}'))" for t in AUTHORS)
REASON_SQL = (f"nullif(concat_ws(' | ', {_hits_sql(KW_HAY, KEYWORDS, fixed.KEYWORD_REASON_PREFIX)}, "
              f"{_hits_sql(AU_HAY, AUTHORS, fixed.AUTHOR_REASON_PREFIX)}), '')")


@register("c2_search_request", with_(PAPERS) + f"""
SELECT id, title, authors, array_to_string(categories, ', ') AS categories,
       strftime(date, '%Y-%m-%d') AS date, concat('https://arxiv.org/abs/', id) AS url,
       {REASON_SQL} AS reason
FROM papers
WHERE ({KW_ANY}) OR ({AU_ANY})""")
def c2_search_request(spark, sf_dir):
    r = search.search_request(_papers(spark, sf_dir), fixed.ALL_CATEGORIES, KEYWORDS, AUTHORS)
    return r.select("id", "title", "authors", F.array_join("categories", ", ").alias("categories"),
                    tf.iso_date("date").alias("date"), "url", F.col("match_reason").alias("reason"))


@register("f3_category_filter", with_(PAPERS) + f"""
SELECT id, title, strftime(date, '%Y-%m-%d') AS date, primary_category
FROM papers WHERE primary_category = '{CATEGORY}'""")
def f3_category_filter(spark, sf_dir):
    v = match.category_filter(match.search_view(_papers(spark, sf_dir)), CATEGORY)
    return v.select("id", "title", tf.iso_date("date").alias("date"), "primary_category")


@register("f4_keyword_match", with_(PAPERS) + f"""
SELECT id, ({KW_ANY}) AS is_matched,
       {_hits_sql(KW_HAY, KEYWORDS, fixed.KEYWORD_REASON_PREFIX)} AS match_reason
FROM papers""")
def f4_keyword_match(spark, sf_dir):
    v = match.match_terms(match.search_view(_papers(spark, sf_dir)), keywords=KEYWORDS)
    return v.select("id", "is_matched", "match_reason")


@register("f5_author_match", with_(PAPERS) + f"""
SELECT id, ({AU_ANY}) AS is_matched,
       {_hits_sql(AU_HAY, AUTHORS, fixed.AUTHOR_REASON_PREFIX)} AS match_reason
FROM papers""")
def f5_author_match(spark, sf_dir):
    v = match.match_terms(match.search_view(_papers(spark, sf_dir)), authors=AUTHORS)
    return v.select("id", "is_matched", "match_reason")


TEXT_HAY = ("lower(concat_ws(' ', coalesce(title, ''), coalesce(authors, ''), array_to_string(categories, ', '), "
            "coalesce(summary, ''), coalesce(summary, ''), '', '', '', ''))")


@register("f7_text_search", with_(PAPERS) + f"""
SELECT id, contains({TEXT_HAY}, lower('{TEXT_QUERY}')) AS is_matched,
       CASE WHEN contains({TEXT_HAY}, lower('{TEXT_QUERY}')) THEN '{fixed.TEXT_REASON_PREFIX}{TEXT_QUERY}' END
         AS match_reason
FROM papers""")
def f7_text_search(spark, sf_dir):
    v = match.match_text(match.search_view(_papers(spark, sf_dir)), TEXT_QUERY)
    return v.select("id", "is_matched", "match_reason")


@register("f9_keyword_drilldown", with_(PAPERS) + f"""
SELECT id, title, strftime(date, '%Y-%m-%d') AS date
FROM papers
WHERE date BETWEEN DATE '{DRILL_FROM}' AND DATE '{DRILL_TO}'
  AND contains({KW_HAY}, lower('{DRILL_KEYWORD}'))""")
def f9_keyword_drilldown(spark, sf_dir):
    r = search.keyword_drilldown(_papers(spark, sf_dir), DRILL_KEYWORD, DRILL_FROM, DRILL_TO)
    return r.select("id", "title", tf.iso_date("date").alias("date"))


RANK_SQL = with_(PAPERS) + f"""
, flagged AS (SELECT *, ({KW_ANY}) OR ({AU_ANY}) AS is_matched FROM papers)
, ranked AS (
  SELECT id, date, is_matched,
         row_number() OVER (PARTITION BY date ORDER BY is_matched DESC, primary_category, seq, id) AS rank,
         count(*) OVER (PARTITION BY date) AS n
  FROM flagged)
"""


@register("o3_reading_list", RANK_SQL + """
SELECT id, strftime(date, '%Y-%m-%d') AS date, is_matched, CAST(rank AS BIGINT) AS rank,
       CAST(n AS BIGINT) AS n, concat(CAST(rank AS VARCHAR), ' / ', CAST(n AS VARCHAR)) AS position
FROM ranked""")
def o3_reading_list(spark, sf_dir):
    r = search.reading_list(_papers(spark, sf_dir), fixed.ALL_CATEGORIES, KEYWORDS, AUTHORS)
    return r.select("id", tf.iso_date("date").alias("date"), "is_matched", "rank", "n",
                    match.position_text().alias("position"))


@register("w5_circular_neighbours", RANK_SQL + """
SELECT id, strftime(date, '%Y-%m-%d') AS date, CAST(rank AS BIGINT) AS rank,
       coalesce(lag(id) OVER w, last_value(id) OVER (PARTITION BY date ORDER BY rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_id,
       coalesce(lead(id) OVER w, first_value(id) OVER w) AS next_id
FROM ranked WINDOW w AS (PARTITION BY date ORDER BY rank)""")
def w5_circular_neighbours(spark, sf_dir):
    r = search.reading_list(_papers(spark, sf_dir), fixed.ALL_CATEGORIES, KEYWORDS, AUTHORS)
    nb = match.circular_neighbours(r)
    return nb.select("id", tf.iso_date("date").alias("date"), "rank", "prev_id", "next_id")


J5_TERMS = """terms AS (
  SELECT DISTINCT term FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS term FROM benchmark
                             UNION ALL SELECT text FROM benchmark) WHERE length(term) > 8)"""


def benchmark_terms(spark, sf_dir):
    """Search terms: every word of a benchmark item of over eight characters, and every whole item."""
    b = load_table(spark, sf_dir, "benchmark")
    words = b.select(F.explode(F.split("text", r"\s+")).alias("term")).unionByName(b.select(F.col("text").alias("term")))
    return words.where(F.length("term") > 8).distinct()


@register("j5_term_join", with_(PAPERS, J5_TERMS) + f"""
SELECT p.id, t.term FROM papers p JOIN terms t ON contains({KW_HAY.replace('title', 'p.title').replace('summary', 'p.summary')}, lower(t.term))""")
def j5_term_join(spark, sf_dir):
    v = match.search_view(_papers(spark, sf_dir))
    return match.term_hits(v, benchmark_terms(spark, sf_dir), match.keyword_haystack())


@register("j5_short_terms", with_(PAPERS) + f"""
, terms AS (SELECT DISTINCT unnest(string_split_regex(text, '\\s+')) AS term FROM benchmark)
SELECT t.term, count(*) AS n_papers FROM papers p JOIN terms t
  ON contains({KW_HAY.replace('title', 'p.title').replace('summary', 'p.summary')}, lower(t.term))
WHERE length(t.term) BETWEEN 1 AND 8 GROUP BY t.term""")
def j5_short_terms(spark, sf_dir):
    """J5 on the hard case: every word of up to eight characters, single letters
    and signs too, with the number of papers that hold it."""
    b = load_table(spark, sf_dir, "benchmark")
    terms = b.select(F.explode(F.split("text", r"\s+")).alias("term")).where(F.length("term").between(1, 8))
    hits = match.term_hits(match.search_view(_papers(spark, sf_dir)), terms, match.keyword_haystack())
    return hits.groupBy("term").agg(F.count(F.lit(1)).alias("n_papers"))


PREFS_SQL = f"""prefs AS (
  SELECT c_custkey AS user_id, 'author' AS kind, concat('Author ', CAST(c_custkey % 37 AS VARCHAR)) AS term
  FROM customer
  UNION ALL
  SELECT c_custkey, 'keyword', list_extract([{_sql_list(PREF_WORDS)}], CAST(c_custkey % {len(PREF_WORDS)} AS INTEGER) + 1)
  FROM customer)"""


def preferences(spark, sf_dir):
    c = load_table(spark, sf_dir, "customer")
    words = F.array(*[F.lit(w) for w in PREF_WORDS])
    a = c.select(F.col("c_custkey").alias("user_id"), F.lit("author").alias("kind"),
                 F.concat(F.lit("Author "), (F.col("c_custkey") % 37).cast("string")).alias("term"))
    k = c.select(F.col("c_custkey").alias("user_id"), F.lit("keyword").alias("kind"),
                 F.element_at(words, (F.col("c_custkey") % len(PREF_WORDS)).cast("int") + 1).alias("term"))
    return a.unionByName(k)


@register("j7_preference_join", with_(PAPERS, PREFS_SQL) + f"""
, t AS (SELECT DISTINCT kind, term FROM prefs)
, n AS (SELECT t.kind, t.term, count(*) AS n_papers FROM papers p JOIN t
  ON (t.kind = 'keyword' AND contains({KW_HAY.replace('title', 'p.title').replace('summary', 'p.summary')}, lower(t.term)))
  OR (t.kind = 'author' AND contains(lower(p.authors), lower(t.term))) GROUP BY ALL)
SELECT u.user_id, u.kind, u.term, CAST(coalesce(n.n_papers, 0) AS BIGINT) AS n_papers
FROM prefs u LEFT JOIN n USING (kind, term)""")
def j7_preference_join(spark, sf_dir):
    """Every stored preference with its number of matching papers."""
    v = match.search_view(_papers(spark, sf_dir))
    return match.preference_counts(v, preferences(spark, sf_dir))


@register("s13_response_document", with_(PAPERS) + f"""
, m AS (SELECT *, {REASON_SQL} AS reason FROM papers WHERE ({KW_ANY}) OR ({AU_ANY}))
SELECT strftime(date, '%Y-%m-%d') AS date, 0 AS part, CAST(0 AS BIGINT) AS pos,
       CAST(to_json({{'category': 'all', 'author': [{_sql_list(AUTHORS)}], 'keywords': [{_sql_list(KEYWORDS)}],
                      'count': count(*)}}) AS VARCHAR) AS json
FROM m GROUP BY date
UNION ALL
SELECT strftime(date, '%Y-%m-%d'), 1, row_number() OVER (PARTITION BY date ORDER BY primary_category, seq, id),
       CAST(to_json({{'id': id, 'title': title, 'authors': authors, 'categories': categories, 'summary': summary,
                      'date': strftime(date, '%Y-%m-%d'), 'url': concat('https://arxiv.org/abs/', id),
                      'reason': reason}}) AS VARCHAR)
FROM m""")
def s13_response_document(spark, sf_dir):
    """The JSON answer per day as ordered parts."""
    r = search.search_request(_papers(spark, sf_dir), fixed.ALL_CATEGORIES, KEYWORDS, AUTHORS)
    return match.response_parts(r, fixed.ALL_CATEGORIES, KEYWORDS, AUTHORS).select(
        tf.iso_date("date").alias("date"), "part", "pos", "json")


@register("p6_author_display", with_(PAPERS) + """
, a AS (SELECT id, list_filter(list_transform(string_split(authors, ','), lambda x: trim(x)), lambda x: x <> '') AS al FROM papers)
SELECT id, CASE WHEN len(al) <= 4 THEN array_to_string(al, ', ')
                ELSE array_to_string(list_concat(al[1:2], ['...'], al[-2:]), ', ') END AS authors_short
FROM a""")
def p6_author_display(spark, sf_dir):
    v = match.search_view(_papers(spark, sf_dir))
    return v.select("id", tf.abbreviate_authors("authors").alias("authors_short"))


@register("p7_highlight", with_(PAPERS) + f"""
SELECT id, regexp_replace(title, '(?i)(the by|nicht|ouen|Eaux)', '<span class="{fixed.HIGHLIGHT_CLASS}">\\1</span>', 'g')
       AS title_html
FROM papers""")
def p7_highlight(spark, sf_dir):
    v = match.search_view(_papers(spark, sf_dir))
    return v.select("id", tf.highlight("title", KEYWORDS).alias("title_html"))


@register("p8_date_formats", with_(PAPERS) + """
SELECT id, strftime(date, '%-m/%-d/%Y') AS shown, strftime(date, '%Y-%m-%d') AS iso FROM papers""")
def p8_date_formats(spark, sf_dir):
    v = _papers(spark, sf_dir)
    return v.select("id", tf.display_date("date").alias("shown"), tf.iso_date("date").alias("iso"))


@register("p1_urls", with_(PAPERS) + """
SELECT id, concat('https://arxiv.org/abs/', id) AS url, concat('https://arxiv.org/pdf/', id) AS pdf,
       regexp_replace(concat('https://arxiv.org/abs/', id, '/abs'), '^(.*?)abs', '\\1html') AS html
FROM papers""")
def p1_urls(spark, sf_dir):
    v = _papers(spark, sf_dir)
    absl = pf.abs_url("id")
    return v.select("id", pf.reader_url(absl, pf.pdf_url("id"), "id").alias("url"), pf.pdf_url("id").alias("pdf"),
                    pf.swap_first_abs(F.concat(absl, F.lit("/abs")), "html").alias("html"))


@register("p12_csv_terms", """
SELECT c_custkey,
       array_to_string(list_filter(list_transform(string_split(concat(' ', c_mktsegment, ' ,, ', c_name, ' ,'), ','),
                                                  lambda x: trim(x)), lambda x: x <> ''), '|') AS terms
FROM customer""")
def p12_csv_terms(spark, sf_dir):
    apply_confs(spark)
    c = load_table(spark, sf_dir, "customer")
    raw = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ,, "), F.col("c_name"), F.lit(" ,"))
    return c.select("c_custkey", F.array_join(tf.csv_terms(raw), "|").alias("terms"))


@register("p18_preference_export", with_(PREFS_SQL) + """
SELECT user_id, kind, string_agg(term, ',' ORDER BY term) AS terms
FROM (SELECT DISTINCT user_id, kind, trim(term) AS term FROM prefs WHERE trim(term) <> '')
GROUP BY ALL""")
def p18_preference_export(spark, sf_dir):
    apply_confs(spark)
    return match.preference_export(preferences(spark, sf_dir))


@register("o8_random_pick", with_(PAPERS) + "SELECT id, title FROM papers ORDER BY md5(concat('7', id)), id LIMIT 1")
def o8_random_pick(spark, sf_dir):
    """One paper, random by seed: the order of the hashes of (seed, id)."""
    from ..sources import feed
    return feed.random_pick(_papers(spark, sf_dir).select("id", "title"), seed=7)
