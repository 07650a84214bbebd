"""Checked queries: keyword statistics (M4, F16, F17, A3, A4, A8, A10, W2,
O5-O7, J6, P13, P17)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tf
from ..operators import trends
from ..session import apply_confs
from ..sources.tables import load_table, papers_view
from ..streaming import feed_stream as fs
from .oracle_views import PAPERS, with_
from .registry import register

RANGE_FROM, RANGE_TO = "2024-01-03", "2024-01-20"


def _papers(spark, sf_dir):
    apply_confs(spark)
    return papers_view(load_table(spark, sf_dir, "documents"))


def _list(vals):
    return "[" + ", ".join(f"'{v}'" for v in vals) + "]"


# DuckDB restatement of candidate extraction and per-title top terms.
CANDS_SQL = with_(PAPERS) + f"""
, n AS (SELECT id, date, lower(trim(regexp_replace(regexp_replace(coalesce(title, ''), '[^\\w\\s]', ' ', 'g'),
                                                 '\\s+', ' ', 'g'))) AS t FROM papers)
, r AS (SELECT id, date, string_split(regexp_replace(t, '{trends.BREAK_PATTERN}', '|', 'g'), '|') AS runs FROM n)
, u AS (SELECT id, date, trim(regexp_replace(unnest(runs), '\\s+', ' ', 'g')) AS run,
               generate_subscripts(runs, 1) AS pos FROM r)
, v AS (SELECT id, date, run, pos, string_split(run, ' ') AS ws FROM u WHERE run <> '')
, c AS (
  SELECT id, date, run, min(pos) AS pos FROM v
  WHERE len(ws) <= {fixed.MAX_PHRASE_WORDS}
    AND list_aggregate(list_transform(ws, lambda w: length(w) >= {fixed.MIN_WORD_CHARS}), 'bool_and')
    AND NOT list_aggregate(list_transform(ws, lambda w: list_contains({_list(fixed.STOP_WORDS)}, w)), 'bool_and')
  GROUP BY id, date, run)
, t10 AS (
  SELECT id, date, run AS keyword, pos,
         row_number() OVER (PARTITION BY id ORDER BY CASE WHEN contains(run, ' ') THEN 0 ELSE 1 END, pos) AS rk,
         sum(CASE WHEN contains(run, ' ') THEN 1.5 ELSE 1.0 END) OVER (PARTITION BY id) AS total
  FROM c)
, kw AS (SELECT id, date, keyword FROM t10 WHERE rk <= {fixed.TERMS_PER_TITLE})
"""


@register("p13_title_normalize", with_(PAPERS) + """
SELECT id, trim(regexp_replace(regexp_replace(coalesce(title, ''), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS norm
FROM papers""")
def p13_title_normalize(spark, sf_dir):
    return _papers(spark, sf_dir).select("id", tf.normalize_title("title").alias("norm"))


@register("m4_title_candidates", CANDS_SQL + """
SELECT id, string_agg(run, '|' ORDER BY pos) AS candidates FROM c GROUP BY id""")
def m4_title_candidates(spark, sf_dir):
    c = _papers(spark, sf_dir).select("id", trends.title_candidates("title").alias("c"))
    return c.where(F.size("c") > 0).select("id", F.array_join("c", "|").alias("candidates"))


@register("w2_top_terms_per_title", CANDS_SQL + """
SELECT id, keyword, CAST(rk AS BIGINT) AS rank FROM t10 WHERE rk <= 10""")
def w2_top_terms_per_title(spark, sf_dir):
    p = _papers(spark, sf_dir).select("id", trends.top_terms(trends.title_candidates("title")).alias("t"))
    return p.select("id", F.posexplode("t").alias("pos", "keyword")).select(
        "id", "keyword", (F.col("pos") + 1).cast("long").alias("rank"))


@register("a8_term_weights", CANDS_SQL + """
SELECT id, keyword, round(CASE WHEN contains(keyword, ' ') THEN 1.5 ELSE 1.0 END / total, 6) AS weight FROM t10""")
def a8_term_weights(spark, sf_dir):
    p = _papers(spark, sf_dir).select("id", trends.term_weights(trends.title_candidates("title")).alias("w"))
    e = p.select("id", F.explode("w").alias("x"))
    return e.select("id", F.col("x.term").alias("keyword"), F.round("x.weight", 6).alias("weight"))


@register("a3_keyword_frequency", CANDS_SQL + """
SELECT keyword, count(*) AS count FROM kw GROUP BY keyword HAVING count(*) > 1""")
def a3_keyword_frequency(spark, sf_dir):
    return trends.keyword_counts(trends.title_keywords(_papers(spark, sf_dir)))


@register("a4_keyword_day_counts", CANDS_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS date, keyword, count(*) AS count FROM kw GROUP BY ALL""")
def a4_keyword_day_counts(spark, sf_dir):
    c = trends.keyword_day_counts(trends.title_keywords(_papers(spark, sf_dir)))
    return c.select(tf.iso_date("date").alias("date"), "keyword", "count")


TOP_SQL = CANDS_SQL + f"""
, cnt AS (SELECT keyword, count(*) AS count FROM kw GROUP BY keyword HAVING count(*) > 1)
, top AS (SELECT keyword, count, row_number() OVER (ORDER BY count DESC, keyword) AS rank FROM cnt
          QUALIFY rank <= {fixed.CLOUD_TOP})
"""


@register("o5_top_keywords", TOP_SQL + """
SELECT keyword, count, CAST(rank AS BIGINT) AS rank, CAST(greatest(12, least(50, count * 3)) AS BIGINT) AS size
FROM top""")
def o5_top_keywords(spark, sf_dir):
    return trends.top_keywords(trends.keyword_counts(trends.title_keywords(_papers(spark, sf_dir))))


RANGE_SQL = TOP_SQL.replace(
    "FROM papers)", f"FROM papers WHERE date BETWEEN DATE '{RANGE_FROM}' AND DATE '{RANGE_TO}')", 1)
# The first "FROM papers)" in CANDS_SQL is the normalisation step: restrict it to the range.
assert RANGE_SQL != TOP_SQL

GRID_SQL = RANGE_SQL + f"""
, tk AS (SELECT keyword FROM top WHERE rank <= {fixed.TREND_TOP})
, ds AS (SELECT DISTINCT date FROM papers WHERE date BETWEEN DATE '{RANGE_FROM}' AND DATE '{RANGE_TO}')
, grid AS (
  SELECT tk.keyword, ds.date, CAST(count(kw.id) AS BIGINT) AS count
  FROM tk CROSS JOIN ds LEFT JOIN kw ON kw.keyword = tk.keyword AND kw.date = ds.date
  GROUP BY ALL)
"""


def _stats(spark, sf_dir):
    return trends.keyword_statistics(_papers(spark, sf_dir), RANGE_FROM, RANGE_TO)


@register("j6_trend_grid", GRID_SQL + "SELECT keyword, strftime(date, '%Y-%m-%d') AS date, count FROM grid")
def j6_trend_grid(spark, sf_dir):
    g = _stats(spark, sf_dir)["trend"]
    return g.select("keyword", tf.iso_date("date").alias("date"), "count")


@register("a10_trend_extent", GRID_SQL + """
SELECT keyword, max(count) AS peak, strftime(min(date), '%Y-%m-%d') AS first_date,
       strftime(max(date), '%Y-%m-%d') AS last_date
FROM grid GROUP BY keyword""")
def a10_trend_extent(spark, sf_dir):
    e = trends.trend_extent(_stats(spark, sf_dir)["trend"])
    return e.select("keyword", "peak", tf.iso_date("first_date").alias("first_date"),
                    tf.iso_date("last_date").alias("last_date"))


@register("o5_top_keywords_range", RANGE_SQL + """
SELECT keyword, count, CAST(rank AS BIGINT) AS rank, CAST(greatest(12, least(50, count * 3)) AS BIGINT) AS size
FROM top""")
def o5_top_keywords_range(spark, sf_dir):
    return _stats(spark, sf_dir)["cloud"]


# --- C4 on a feed with language variants (S5) --------------------------------
STATS_LANGUAGES = ("de", "en")         # preferred, default
VARIANT_SQL = CANDS_SQL.replace("FROM papers)", """FROM (
  SELECT * FROM papers SEMI JOIN (SELECT date, language FROM (SELECT DISTINCT date, language FROM papers)
    QUALIFY row_number() OVER (PARTITION BY date ORDER BY CASE WHEN language = '%s' THEN 0 WHEN language = '%s' THEN 1 ELSE 2 END, language) = 1) c
  USING (date, language)))""" % STATS_LANGUAGES, 1)
assert VARIANT_SQL != CANDS_SQL


def variant_statistics(spark, sf_dir):
    """Keyword statistics over a published feed, each day in one language."""
    from ..session import checkpoint_dir
    from ..sources import feed
    path = f"{checkpoint_dir(spark).rstrip('/')}/variants-{uuid.uuid4().hex}"
    papers = _papers(spark, sf_dir).select("id", "title", "summary", "date", "language")
    papers.write.partitionBy("date", "language").parquet(path)
    return trends.keyword_statistics(spark.read.parquet(path), preferred=STATS_LANGUAGES[0], default=STATS_LANGUAGES[1],
                                     listed=feed.slices(feed.list_files(spark, path)))


@register("c4_variant_day_counts", VARIANT_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS date, keyword, count(*) AS count FROM kw GROUP BY ALL""")
def c4_variant_day_counts(spark, sf_dir):
    c = variant_statistics(spark, sf_dir)["day_counts"]
    return c.select(tf.iso_date("date").alias("date"), "keyword", "count")


# --- T3 on titles ---------------------------------------------------------------
def _paper_stream(spark, sf_dir):
    """(stream of all papers, folder for its outputs)."""
    from ..session import checkpoint_dir
    base = f"{checkpoint_dir(spark).rstrip('/')}/t3-{uuid.uuid4().hex}"
    papers = _papers(spark, sf_dir).select("id", "title", "date", "primary_category")
    papers.write.parquet(f"{base}/src")
    return spark.readStream.schema(papers.schema).parquet(f"{base}/src"), base


@register("t3_stream_keyword_trends", CANDS_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS date, keyword, count(*) AS n FROM kw GROUP BY ALL""")
def t3_stream_keyword_trends(spark, sf_dir):
    """Keywords per day as a stream; equals the batch counts of all days."""
    stream, base = _paper_stream(spark, sf_dir)
    fs.run_keyword_trends(stream, f"{base}/out", f"{base}/ckpt").awaitTermination()
    return fs.stored_daily_counts(spark, f"{base}/out", "keyword").select(tf.iso_date("date").alias("date"), "keyword", "n")


@register("t3_stream_category_counts", with_(PAPERS) + """
SELECT strftime(date, '%Y-%m-%d') AS date, primary_category, count(*) AS n FROM papers
WHERE primary_category IS NOT NULL AND primary_category <> '' GROUP BY ALL""")
def t3_stream_category_counts(spark, sf_dir):
    stream, base = _paper_stream(spark, sf_dir)
    fs.run_category_counts(stream, f"{base}/out", f"{base}/ckpt").awaitTermination()
    return fs.stored_daily_counts(spark, f"{base}/out", "primary_category").select(tf.iso_date("date").alias("date"), "primary_category", "n")
