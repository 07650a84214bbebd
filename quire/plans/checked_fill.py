"""Checked queries: metadata fill (J2), repository facts (J3, P11), verdict
lookup (J4), safety gate (F13)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import papers as pf
from ..operators import fill
from ..session import apply_confs
from ..sources.tables import enriched_view, load_table, papers_view
from .oracle_views import PAPERS, with_
from .registry import register


def _tables(spark, sf_dir, *names):
    apply_confs(spark)
    return [load_table(spark, sf_dir, n) for n in names]


def _raw_papers(spark, sf_dir):
    """Crawled rows with gaps: German titles and one source's authors are missing."""
    (docs,) = _tables(spark, sf_dir, "documents")
    p = papers_view(docs)
    return p.select(
        "id", "seq",
        F.when(F.col("language") == "de", F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(F.col("primary_category") == "src5", F.array().cast("array<string>")).otherwise(F.col("authors"))
        .alias("authors"),
        "categories", "summary")


def _metadata(spark, sf_dir):
    """The metadata service knows the labelled documents only."""
    docs, labels = _tables(spark, sf_dir, "documents", "labels")
    p = papers_view(docs.join(labels.select("doc_id"), "doc_id", "left_semi"))
    return p.select("id", F.concat(F.lit("[meta] "), F.col("title")).alias("title"), "authors", "categories",
                    F.concat(F.lit("pages: "), F.length("summary").cast("string")).alias("comment"), "summary")


RAW_SQL = """raw AS (
  SELECT id, seq, CASE WHEN language = 'de' THEN '' ELSE title END AS title,
         CASE WHEN primary_category = 'src5' THEN []::VARCHAR[] ELSE string_split(authors, ', ') END AS authors,
         categories, summary
  FROM papers),
meta AS (
  SELECT id, concat('[meta] ', title) AS title, string_split(authors, ', ') AS authors, categories,
         concat('pages: ', CAST(length(summary) AS VARCHAR)) AS comment, summary
  FROM papers WHERE CAST(id AS BIGINT) IN (SELECT doc_id FROM labels))"""


@register("j2_metadata_fill", with_(PAPERS, RAW_SQL) + """
, flagged AS (SELECT *, title <> '' AND len(authors) > 0 AND len(categories) > 0 AND summary <> '' AS complete
              FROM raw)
SELECT f.id, CASE WHEN NOT f.complete AND m.id IS NOT NULL THEN m.title ELSE f.title END AS title,
       array_to_string(CASE WHEN NOT f.complete AND m.id IS NOT NULL THEN m.authors ELSE f.authors END, ', ') AS authors,
       CASE WHEN f.complete THEN '' WHEN m.id IS NOT NULL THEN m.comment END AS comment,
       f.complete AS was_complete
FROM flagged f LEFT JOIN meta m ON NOT f.complete AND m.id = f.id""")
def j2_metadata_fill(spark, sf_dir):
    raw = _raw_papers(spark, sf_dir)
    complete = (F.col("title") != "") & (F.size("authors") > 0)
    out = fill.fill_metadata(raw.withColumn("was_complete", complete), _metadata(spark, sf_dir))
    return out.select("id", "title", F.array_join("authors", ", ").alias("authors"), "comment", "was_complete")


LINK_SQL = """links AS (
  SELECT c_custkey,
         CASE CAST(c_custkey % 6 AS INTEGER)
           WHEN 0 THEN concat('Code: https://github.com/user', CAST(c_custkey % 50 AS VARCHAR), '/repo', CAST(c_nationkey AS VARCHAR), ' and more')
           WHEN 1 THEN concat('See https://github.com/user', CAST(c_custkey % 50 AS VARCHAR), '/repo', CAST(c_nationkey AS VARCHAR), '.git).')
           WHEN 2 THEN concat('(https://github.com/user', CAST(c_custkey % 50 AS VARCHAR), '/toolkit', CAST(c_nationkey AS VARCHAR), '.), done')
           WHEN 3 THEN concat('Project page: https://user', CAST(c_custkey % 50 AS VARCHAR), '.github.io/proj/v1.')
           WHEN 4 THEN concat('http://github.com/user', CAST(c_custkey % 50 AS VARCHAR), '/toolkit and https://x.github.io/y')
           ELSE concat('no code for ', c_name) END AS text
  FROM customer),
stats AS (
  SELECT concat('user', CAST(s_suppkey % 50 AS VARCHAR)) AS owner, concat('repo', CAST(s_nationkey AS VARCHAR)) AS repo,
         max(s_suppkey) AS stars,
         concat('2024-01-', lpad(CAST(max(s_suppkey) % 28 + 1 AS VARCHAR), 2, '0'), 'T10:00:00Z') AS pushed_at
  FROM supplier GROUP BY ALL)"""

OWNER = f"nullif(regexp_extract(text, '{fixed.GITHUB_REPO_PATTERN}', 1), '')"
REPO = f"nullif(regexp_replace(regexp_extract(text, '{fixed.GITHUB_REPO_PATTERN}', 2), '(\\.git)?\\.*$', ''), '')"
PAGES = f"nullif(regexp_replace(regexp_extract(text, '{fixed.GITHUB_PAGES_PATTERN}', 0), '\\.+$', ''), '')"


def repo_stats(spark, sf_dir):
    (sup,) = _tables(spark, sf_dir, "supplier")
    g = sup.groupBy(F.concat(F.lit("user"), (F.col("s_suppkey") % 50).cast("string")).alias("owner"),
                    F.concat(F.lit("repo"), F.col("s_nationkey").cast("string")).alias("repo")).agg(
        F.max("s_suppkey").alias("stars"))
    day = F.lpad((F.col("stars") % 28 + 1).cast("string"), 2, "0")
    return g.withColumn("pushed_at", F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00Z")))


def link_texts(spark, sf_dir):
    (c,) = _tables(spark, sf_dir, "customer")
    u = (F.col("c_custkey") % 50).cast("string")
    n = F.col("c_nationkey").cast("string")
    k = (F.col("c_custkey") % 6).cast("int")
    t = (F.when(k == 0, F.concat(F.lit("Code: https://github.com/user"), u, F.lit("/repo"), n, F.lit(" and more")))
         .when(k == 1, F.concat(F.lit("See https://github.com/user"), u, F.lit("/repo"), n, F.lit(".git).")))
         .when(k == 2, F.concat(F.lit("(https://github.com/user"), u, F.lit("/toolkit"), n, F.lit(".), done")))
         .when(k == 3, F.concat(F.lit("Project page: https://user"), u, F.lit(".github.io/proj/v1.")))
         .when(k == 4, F.concat(F.lit("http://github.com/user"), u, F.lit("/toolkit and https://x.github.io/y")))
         .otherwise(F.concat(F.lit("no code for "), F.col("c_name"))))
    return c.select("c_custkey", t.alias("text"))


@register("p11_code_links", with_(LINK_SQL) + f"""
SELECT c_custkey, coalesce(CASE WHEN {OWNER} IS NOT NULL THEN concat('{fixed.GITHUB_URL_PREFIX}', {OWNER}, '/', coalesce({REPO}, '')) END,
                           {PAGES}) AS code_url
FROM links""")
def p11_code_links(spark, sf_dir):
    return link_texts(spark, sf_dir).select("c_custkey", pf.code_url("text").alias("code_url"))


@register("j3_repo_facts", with_(LINK_SQL) + f"""
, x AS (SELECT c_custkey, text, {OWNER} AS owner, {REPO} AS repo FROM links)
SELECT x.c_custkey,
       coalesce(CASE WHEN x.owner IS NOT NULL THEN concat('{fixed.GITHUB_URL_PREFIX}', x.owner, '/', coalesce(x.repo, '')) END,
                {PAGES.replace('text', 'x.text')}) AS code_url,
       CAST(coalesce(s.stars, 0) AS BIGINT) AS code_stars, coalesce(substring(s.pushed_at, 1, 10), '') AS code_last_update
FROM x LEFT JOIN stats s ON s.owner = x.owner AND s.repo = x.repo""")
def j3_repo_facts(spark, sf_dir):
    r = fill.repo_facts(link_texts(spark, sf_dir), repo_stats(spark, sf_dir), "text")
    return r.select("c_custkey", "code_url", "code_stars", "code_last_update")


VERDICTS_SQL = """verdicts AS (
  SELECT DISTINCT sha256(d.text) AS text_hash, l.toxic = 1 AS flagged
  FROM documents d JOIN labels l USING (doc_id))"""


def verdicts(spark, sf_dir):
    """Safety verdicts known for labelled documents (toxic = flagged)."""
    docs, labels = _tables(spark, sf_dir, "documents", "labels")
    return docs.join(labels, "doc_id").select(fill.text_hash("text").alias("text_hash"),
                                              (F.col("toxic") == 1).alias("flagged")).distinct()


@register("j4_verdict_lookup", with_(PAPERS, VERDICTS_SQL) + """
SELECT p.id, coalesce(bool_or(v.flagged), false) AS flagged
FROM papers p LEFT JOIN verdicts v ON v.text_hash = sha256(p.summary) GROUP BY p.id""")
def j4_verdict_lookup(spark, sf_dir):
    (docs,) = _tables(spark, sf_dir, "documents")
    v = verdicts(spark, sf_dir).groupBy("text_hash").agg(F.bool_or("flagged").alias("flagged"))
    return fill.verdict_lookup(papers_view(docs), v).select("id", "flagged")


GATE_SQL = with_(PAPERS, VERDICTS_SQL) + """
, e AS (SELECT id, summary,
               nullif(split_part(summary, chr(10), 2), '') AS tldr,
               nullif(split_part(summary, chr(10), 3), '') AS motivation,
               nullif(split_part(summary, chr(10), 4), '') AS method,
               nullif(split_part(summary, chr(10), 5), '') AS result,
               nullif(split_part(summary, chr(10), 6), '') AS conclusion FROM papers)
, t AS (SELECT id, 0 AS pos, 'summary' AS field, summary AS txt FROM e
        UNION ALL SELECT id, 1, 'AI.tldr', tldr FROM e UNION ALL SELECT id, 2, 'AI.motivation', motivation FROM e
        UNION ALL SELECT id, 3, 'AI.method', method FROM e UNION ALL SELECT id, 4, 'AI.result', result FROM e
        UNION ALL SELECT id, 5, 'AI.conclusion', conclusion FROM e)
, q AS (SELECT t.id, arg_min(t.field, t.pos) AS reason FROM t
        WHERE t.txt IS NOT NULL AND sha256(t.txt) IN (SELECT text_hash FROM verdicts WHERE flagged)
        GROUP BY t.id)
"""


@register("f13_safety_gate", GATE_SQL + """
SELECT e.id, q.reason, q.id IS NULL AS kept FROM e LEFT JOIN q USING (id)""")
def f13_safety_gate(spark, sf_dir):
    (docs,) = _tables(spark, sf_dir, "documents")
    kept, quarantine = fill.safety_gate(enriched_view(docs), verdicts(spark, sf_dir))
    return (kept.select("id", F.lit(None).cast("string").alias("reason"), F.lit(True).alias("kept"))
            .unionByName(quarantine.select("id", "reason", F.lit(False).alias("kept"))))
