"""Checked queries: category counts and order (A1, O1), section totals and
preference rank (A2, O2), digest entries and lines (F15, W4, S10), archive
index (S12), languages per date (A9)."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tf
from ..operators import digest
from ..session import apply_confs
from ..sources.tables import enriched_view, load_table, papers_view
from .oracle_views import PAPERS, with_
from .registry import register

PREFERENCE = ["src7", "src2"]


def _enriched(spark, sf_dir):
    apply_confs(spark)
    return enriched_view(load_table(spark, sf_dir, "documents"))


def _papers(spark, sf_dir):
    apply_confs(spark)
    return papers_view(load_table(spark, sf_dir, "documents"))


def render_sql(template: str, **slots: str) -> str:
    """DuckDB form of ``quire.functions.text.render``."""
    parts = re.split(r"\{(\w+)\}", template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append("'" + p.replace("'", "''") + "'")
        else:
            out.append(f"coalesce(CAST({slots[p]} AS VARCHAR), '')")
    return "concat(" + ", ".join(out) + ")"


ENRICHED = """enriched AS (
  SELECT *, concat('https://arxiv.org/abs/', id) AS abs,
         nullif(split_part(summary, chr(10), 2), '') AS tldr,
         nullif(split_part(summary, chr(10), 3), '') AS motivation,
         nullif(split_part(summary, chr(10), 4), '') AS method,
         nullif(split_part(summary, chr(10), 5), '') AS result,
         nullif(split_part(summary, chr(10), 6), '') AS conclusion
  FROM papers)"""

PREF_LIST = "[" + ", ".join(f"'{p}'" for p in PREFERENCE) + "]"
CAT_RANK = (f"CASE WHEN list_contains({PREF_LIST}, primary_category) "
            f"THEN list_position({PREF_LIST}, primary_category) - 1 ELSE {len(PREFERENCE)} END")


@register("a1_category_counts", with_(PAPERS) + """
SELECT strftime(date, '%Y-%m-%d') AS date, primary_category, count(*) AS n,
       CAST(CASE grouping(date, primary_category) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS INTEGER) AS level
FROM papers WHERE primary_category IS NOT NULL AND primary_category <> ''
GROUP BY ROLLUP (date, primary_category)""")
def a1_category_counts(spark, sf_dir):
    c = digest.category_counts(_papers(spark, sf_dir))
    return c.select(tf.iso_date("date").alias("date"), "primary_category", "n", "level")


@register("o1_category_order", with_(PAPERS) + """
SELECT primary_category, row_number() OVER (ORDER BY primary_category) AS "order"
FROM (SELECT DISTINCT primary_category FROM papers)""")
def o1_category_order(spark, sf_dir):
    return digest.category_order(_papers(spark, sf_dir))


@register("a2_section_totals", with_(PAPERS) + f"""
SELECT strftime(date, '%Y-%m-%d') AS date, primary_category, count(*) AS total,
       CAST({CAT_RANK} AS INTEGER) AS cat_rank
FROM papers WHERE primary_category IS NOT NULL AND primary_category <> '' GROUP BY ALL""")
def a2_section_totals(spark, sf_dir):
    t = digest.section_totals(_papers(spark, sf_dir), PREFERENCE)
    return t.select(tf.iso_date("date").alias("date"), "primary_category", "total", "cat_rank")


MD_SQL = render_sql(fixed.DIGEST_ENTRY_TEMPLATE, idx="idx", title="title", url="abs",
                    authors="replace(authors, ', ', ',')", cate="primary_category", summary="summary",
                    tldr="tldr", motivation="motivation", method="method", result="result", conclusion="conclusion")

ENTRIES_SQL = with_(PAPERS, ENRICHED) + f"""
, e AS (SELECT *, {CAT_RANK} AS cat_rank FROM enriched
        WHERE primary_category IS NOT NULL AND primary_category <> ''
          AND tldr IS NOT NULL AND motivation IS NOT NULL AND method IS NOT NULL
          AND result IS NOT NULL AND conclusion IS NOT NULL)
, n AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY cat_rank, primary_category, seq, id) AS idx FROM e)
, entries AS (SELECT date, primary_category, cat_rank, idx, seq, {MD_SQL} AS md FROM n)
"""


@register("s10_digest_entries", ENTRIES_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(idx AS BIGINT) AS idx, seq, primary_category, md FROM entries""")
def s10_digest_entries(spark, sf_dir):
    e = digest.digest_entries(_enriched(spark, sf_dir), PREFERENCE)
    return e.select(tf.iso_date("date").alias("date"), "idx", "seq", "primary_category", "md")


TOC_SQL = render_sql(fixed.DIGEST_TOC_LINE, cate="primary_category", count="total")
SEC_SQL = render_sql(fixed.DIGEST_SECTION_HEADER, cate="primary_category")
HEAD_LIT = "'" + fixed.DIGEST_TOC_HEADER.replace("'", "''") + "'"
SEP_LIT = "'" + fixed.DIGEST_ENTRY_SEPARATOR + "'"


@register("s10_digest_lines", ENTRIES_SQL + f"""
, totals AS (SELECT date, primary_category, count(*) AS total, {CAT_RANK} AS cat_rank FROM papers
             WHERE primary_category IS NOT NULL AND primary_category <> '' GROUP BY ALL)
, firsts AS (SELECT date, primary_category, min(idx) AS f FROM entries GROUP BY ALL)
, fr AS (
  SELECT DISTINCT date, 0 AS part, -1 AS cat_rank, '' AS primary_category, 0 AS idx, {HEAD_LIT} AS text FROM totals
  UNION ALL SELECT date, 1, cat_rank, primary_category, 0, {TOC_SQL} FROM totals
  UNION ALL SELECT date, 2, cat_rank, primary_category, 0, {SEC_SQL} FROM totals
  UNION ALL SELECT e.date, 2, e.cat_rank, e.primary_category, e.idx,
                   CASE WHEN e.idx = f.f THEN e.md ELSE concat({SEP_LIT}, e.md) END
            FROM entries e JOIN firsts f USING (date, primary_category))
, fn AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY part, cat_rank, primary_category, idx) AS frag_no
         FROM fr)
, ln AS (SELECT date, frag_no,
                unnest(string_split(substring(text, 1, length(text) - 1), chr(10))) AS line,
                generate_subscripts(string_split(substring(text, 1, length(text) - 1), chr(10)), 1) AS sub
         FROM fn)
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(frag_no AS BIGINT) AS frag_no, CAST(sub AS BIGINT) AS sub, line
FROM ln""")
def s10_digest_lines(spark, sf_dir):
    ln = digest.digest_lines(_enriched(spark, sf_dir), PREFERENCE)
    return ln.select(tf.iso_date("date").alias("date"), "frag_no", "sub", "line")


@register("s12_archive_index", with_(PAPERS) + """
SELECT string_agg(concat('[', d, '](data/', d, '.md)'), chr(10) || chr(10) ORDER BY d DESC) AS "index"
FROM (SELECT DISTINCT strftime(date, '%Y-%m-%d') AS d FROM papers)""")
def s12_archive_index(spark, sf_dir):
    return digest.archive_index(_papers(spark, sf_dir))


@register("a9_languages_per_date", with_(PAPERS) + """
SELECT strftime(date, '%Y-%m-%d') AS date, array_to_string(list_sort(list_distinct(list(language))), ',') AS languages
FROM papers GROUP BY date""")
def a9_languages_per_date(spark, sf_dir):
    r = digest.languages_per_date(_papers(spark, sf_dir))
    return r.select(tf.iso_date("date").alias("date"), "languages")


@register("f15_digest_skipped", with_(PAPERS, ENRICHED) + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS skipped
FROM enriched
WHERE tldr IS NULL OR motivation IS NULL OR method IS NULL OR result IS NULL OR conclusion IS NULL
GROUP BY ALL""")
def f15_digest_skipped(spark, sf_dir):
    """rows left out of the digest for missing model fields, per day."""
    e = _enriched(spark, sf_dir).where(~digest.complete_ai())
    return e.groupBy(tf.iso_date("date").alias("date")).agg(F.count(F.lit(1)).alias("skipped"))
