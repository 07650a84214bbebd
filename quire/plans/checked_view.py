"""Checked queries: what readers see of a paper (P4, P5, P6, P14, P18), orders
for presentation (O4, O7), day scans (S3), rows without a category (F14) and
abstract pages (S15).

The papers of these checks have what plain ones lack: model fields for some,
code facts for some, one to seven authors, categories as lists, scalars, empty.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tf
from ..operators import match, trends
from ..session import checkpoint_dir
from ..sources import feed, pages
from ..sources.tables import load_table, papers_view
from .checked_sources import DAY, WS, _escaped, _export
from .checked_trends import GRID_SQL, _stats
from .oracle_views import PAPERS, with_
from .registry import register

#: Papers with all that a reader may show; ``text`` is cut by words for the model fields.
SHOWN = """shown AS (
  SELECT * EXCLUDE (authors, categories),
         array_to_string(list_transform(range(1, CAST(seq % 7 AS INTEGER) + 2), lambda i: concat('Name ', CAST((seq * i) % 53 AS VARCHAR))), ', ') AS authors,
         CASE seq % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '[]' WHEN 3 THEN primary_category
              ELSE concat('["', primary_category, '", "extra"]') END AS raw_categories,
         CASE WHEN seq % 3 = 0 THEN NULL WHEN seq % 3 = 1 THEN '' ELSE concat('short ', split_part(title, ' ', 1)) END AS tldr,
         CASE WHEN seq % 3 <> 0 THEN split_part(summary, ' ', 2) END AS motivation,
         CASE WHEN seq % 3 <> 0 THEN concat('METHOD-', split_part(summary, ' ', 3)) END AS method,
         CASE WHEN seq % 2 = 0 THEN NULL WHEN seq % 4 = 1 THEN '' ELSE concat('https://github.com/u/r', seq) END AS code_url,
         CASE WHEN seq % 4 = 3 THEN seq END AS code_stars
  FROM papers)"""


def shown_papers(spark, sf_dir) -> DataFrame:
    p = papers_view(load_table(spark, sf_dir, "documents"))
    seq = F.col("seq")
    # The n-th word at a blank, '' beyond the last (whole texts are not split for it).
    word = lambda c, n: F.get(F.split(F.coalesce(F.col(c), F.lit("")), " ", n + 1), n - 1)
    nth = lambda c, n: F.when(F.col(c).isNotNull(), F.coalesce(word(c, n), F.lit("")))
    names = F.transform(F.sequence(F.lit(1), (seq % 7 + 1).cast("int")), lambda i: F.concat(F.lit("Name "), ((seq * i) % 53).cast("string")))
    raw = (F.when(seq % 5 == 0, "").when(seq % 5 == 1, F.lit(None)).when(seq % 5 == 2, "[]").when(seq % 5 == 3, F.col("primary_category"))
           .otherwise(F.concat(F.lit('["'), "primary_category", F.lit('", "extra"]'))))
    ai = F.when(seq % 3 != 0, F.struct(
        F.when(seq % 3 == 1, F.lit("")).otherwise(F.concat(F.lit("short "), nth("title", 1))).alias("tldr"), nth("summary", 2).alias("motivation"),
        F.concat(F.lit("METHOD-"), nth("summary", 3)).alias("method"), F.lit(None).cast("string").alias("result"), F.lit("").alias("conclusion")))
    url = F.when(seq % 2 == 0, F.lit(None)).when(seq % 4 == 1, "").otherwise(F.concat(F.lit("https://github.com/u/r"), seq.cast("string")))
    return (p.drop("categories").withColumn("authors", names).withColumn("raw_categories", raw).withColumn("AI", ai)
            .withColumn("code_url", url).withColumn("code_stars", F.when(seq % 4 == 3, seq))
            .withColumn("code_last_update", F.when(seq % 4 == 3, F.lit("2024-01-02"))))


def _view(spark, sf_dir) -> DataFrame:
    return match.search_view(shown_papers(spark, sf_dir).withColumn("categories", F.array("primary_category")))


@register("p4_summary_choice", with_(PAPERS, SHOWN) + """
SELECT id, coalesce(nullif(tldr, ''), summary) AS summary, coalesce(summary, '') AS details FROM shown""")
def p4_summary_choice(spark, sf_dir):
    """The tl;dr where there is one, else the abstract."""
    return _view(spark, sf_dir).select("id", "summary", "details")


@register("p5_field_defaults", with_(PAPERS, SHOWN) + """
SELECT id, coalesce(motivation, '') AS motivation, coalesce(method, '') AS method, '' AS result, '' AS conclusion,
       coalesce(code_url, '') AS code_url, coalesce(code_stars, 0) AS code_stars,
       CASE WHEN seq % 4 = 3 THEN '2024-01-02' ELSE '' END AS code_last_update
FROM shown""")
def p5_field_defaults(spark, sf_dir):
    """P5: '' and 0 where a field is absent, null or empty."""
    return _view(spark, sf_dir).select("id", "motivation", "method", "result", "conclusion", "code_url", "code_stars", "code_last_update")


@register("p6_many_authors", with_(PAPERS, SHOWN) + """
, a AS (SELECT id, string_split(authors, ', ') AS al FROM shown)
SELECT id, CASE WHEN len(al) <= 4 THEN array_to_string(al, ', ')
                ELSE array_to_string(list_concat(al[1:2], ['...'], al[-2:]), ', ') END AS authors_short
FROM a""")
def p6_many_authors(spark, sf_dir):
    """P6 with one to seven authors."""
    return _view(spark, sf_dir).select("id", tf.abbreviate_authors("authors").alias("authors_short"))


FIELD_QUERY = "method-"


@register("p14_model_fields", with_(PAPERS, SHOWN) + f"""
SELECT id, contains(lower(concat_ws(' ', coalesce(title, ''), authors, primary_category, coalesce(nullif(tldr, ''), summary, ''), coalesce(summary, ''),
       coalesce(motivation, ''), coalesce(method, ''))), '{FIELD_QUERY}') AS is_matched
FROM shown""")
def p14_model_fields(spark, sf_dir):
    """P14 + F7: a text that only model fields hold."""
    return match.match_text(_view(spark, sf_dir), FIELD_QUERY).select("id", "is_matched")


@register("p18_added_order", """
WITH prefs AS (SELECT doc_id % 11 AS user_id, CASE WHEN doc_id % 2 = 0 THEN 'keyword' ELSE 'author' END AS kind,
                      split_part(text, ' ', 1) AS term, (doc_id * 7919) % 1009 AS pos FROM documents),
first AS (SELECT user_id, kind, trim(term) AS term, min(pos) AS pos FROM prefs WHERE trim(term) <> '' GROUP BY ALL)
SELECT user_id, kind, string_agg(term, ',' ORDER BY pos, term) AS terms FROM first GROUP BY ALL""")
def p18_added_order(spark, sf_dir):
    """Lists in the order in which terms were added."""
    d = load_table(spark, sf_dir, "documents")
    prefs = d.select((F.col("doc_id") % 11).alias("user_id"), F.when(F.col("doc_id") % 2 == 0, "keyword").otherwise("author").alias("kind"),
                     F.substring_index("text", " ", 1).alias("term"), (F.col("doc_id") * 7919 % 1009).alias("pos"))
    return match.preference_export(prefs)


@register("f14_no_category", with_(PAPERS, SHOWN) + """
SELECT id, primary_category, CASE seq % 5 WHEN 3 THEN primary_category ELSE concat(primary_category, ',extra') END AS categories
FROM shown WHERE seq % 5 > 2 AND primary_category <> ''""")
def f14_no_category(spark, sf_dir):
    """F14 + P2: rows whose categories are absent, empty or an empty list are dropped."""
    raw = shown_papers(spark, sf_dir).drop("primary_category").withColumnRenamed("raw_categories", "categories")
    return feed.normalize(raw).select("id", "primary_category", F.array_join("categories", ",").alias("categories"))


def _places(ordered: DataFrame, *keys: str) -> DataFrame:
    """Rows with their place in the order that ``ordered`` gives them (few rows)."""
    w = Window.orderBy("_at")
    return ordered.withColumn("_at", F.monotonically_increasing_id()).select(*keys, F.row_number().over(w).cast("long").alias("place"))


@register("o4_newest_first", with_(PAPERS) + """
SELECT strftime(date, '%Y-%m-%d') AS date, row_number() OVER (ORDER BY date DESC) AS place FROM (SELECT DISTINCT date FROM papers)""")
def o4_newest_first(spark, sf_dir):
    dates = papers_view(load_table(spark, sf_dir, "documents")).select("date").distinct()
    return _places(feed.newest_first(dates), "date").withColumn("date", tf.iso_date("date"))


@register("o7_chronological", GRID_SQL + """
SELECT keyword, strftime(date, '%Y-%m-%d') AS date, count, row_number() OVER (ORDER BY keyword, date) AS place FROM grid""")
def o7_chronological(spark, sf_dir):
    return _places(trends.chronological(_stats(spark, sf_dir)["trend"]), "keyword", "date", "count").withColumn("date", tf.iso_date("date"))


@register("s3_day_scan", with_(PAPERS) + f"SELECT id, 'present' AS day FROM papers WHERE date = DATE '{DAY}'")
def s3_day_scan(spark, sf_dir):
    """S3: a day's rows; a day without a folder, a folder without a file and a
    feed that is not there have none."""
    path = _export(spark, sf_dir, clean=True)
    out = feed.read_day(spark, path, DAY).select("id", F.lit("present").alias("day"))
    feed.touch(spark, f"{path}/date=2024-03-01/language=en/part-empty.txt")
    for name, root, day in (("absent", path, "2031-01-01"), ("empty", path, "2024-03-01"), ("no feed", f"{path}-{uuid.uuid4().hex}", DAY)):
        out = out.unionByName(feed.read_day(spark, root, day).select("id", F.lit(name).alias("day")))
    return out


ABSTRACTS = f"""abstracts AS (
  SELECT seq, id, trim(title, {WS}) AS title, trim(summary, {WS}) AS summary, string_split(authors, ', ') AS authors, concat('p. ', seq) AS comment,
         CASE WHEN seq % 4 = 0 THEN NULL ELSE [concat(primary_category, '.X'), language] END AS categories
  FROM papers)"""


def abstract_pages(spark, sf_dir) -> DataFrame:
    p = papers_view(load_table(spark, sf_dir, "documents"))
    text = lambda c: _escaped(F.coalesce(F.col(c), F.lit("")))
    links = F.array_join(F.transform("authors", lambda a: F.concat(F.lit('<a href="/a">'), a, F.lit("</a>"))), ", ")
    codes = F.when(F.col("seq") % 4 == 0, "none").otherwise(F.concat(F.lit("One ("), "primary_category", F.lit(".X); Two ("), "language", F.lit(")")))
    html = F.concat(F.lit("<html><body><h1 class=\"title mathjax\"><span class='descriptor'>Title:</span>"), text("title"),
                    F.lit('</h1><div class="authors"><span class="descriptor">Authors:</span>'), links,
                    F.lit("</div><blockquote class=\"abstract mathjax\"><span class='descriptor'>Abstract:</span>"), text("summary"),
                    F.lit('</blockquote><table><tr><td class="tablecell label">Comments:</td><td class="tablecell comments">p. '), F.col("seq").cast("string"),
                    F.lit('</td></tr><tr><td class="tablecell label">Subjects:</td><td class="tablecell subjects">'), codes, F.lit("</td></tr></table></body></html>"))
    return p.select(F.concat(F.lit("https://host/abs/"), "id", F.when(F.col("seq") % 2 == 0, "/").otherwise("")).alias("url"), html.alias("html"))


@register("s15_abstract_record", with_(PAPERS, ABSTRACTS) + f"""
SELECT id, concat('{fixed.PDF_URL_PREFIX}', id) AS pdf, concat('{fixed.ABS_URL_PREFIX}', id) AS abs, coalesce(title, '') AS title,
       array_to_string(authors, '|') AS authors, coalesce(summary, '') AS summary, comment, coalesce(array_to_string(categories, '|'), 'listed') AS categories
FROM abstracts""")
def s15_abstract_record(spark, sf_dir):
    """Full records of abstract pages; categories of the listing where the page has none."""
    r = pages.abstract_record(abstract_pages(spark, sf_dir), F.array(F.lit("listed")))
    return r.select("id", "pdf", "abs", "title", F.array_join("authors", "|").alias("authors"), "summary", "comment", F.array_join("categories", "|").alias("categories"))
