"""Checked queries: the published day (C1) and model calls through the ledger
(M1-M3), each with an oracle.

The functions called here are local and plain enough to be said in SQL: they
answer by the length and the pieces of their prompt and fail for some prompts
on purpose.  Paper ids are content hashes, so exact copies of earlier days are
removed by the look-back.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tf
from ..operators import infer
from ..session import checkpoint_dir
from ..sources import feed
from ..sources.tables import load_table, papers_view
from .checked_digest import CAT_RANK, PREFERENCE, render_sql
from .checked_fill import OWNER, PAGES, REPO
from .daily import DailyConfig, daily_job
from .oracle_views import PAPERS, with_
from .registry import register

RUN_DATE = "2024-01-15"


def brief(prompt: str) -> str:
    """A summary made of the prompt's own pieces; no answer for every 11th length."""
    n = len(prompt)
    if n % 11 == 0:
        raise RuntimeError("service unavailable")
    return json.dumps({"tldr": prompt[-25:], "motivation": f"{n} characters", "method": prompt[20:45], "result": n % 7, "conclusion": "ok"})


def verdict(prompt: str) -> str:
    n = len(prompt)
    if n % 13 == 0:
        raise RuntimeError("service unavailable")
    return json.dumps({"relevant": n % 3 != 0, "confidence": 0.9 if n % 2 else 0.4, "reason": f"length {n}", "topics": []})


def flagged(text: str) -> bool:
    return "nicht" in text.lower()


def _no_pause(_seconds: float) -> None:
    return None


def _identified(spark, sf_dir):
    return papers_view(load_table(spark, sf_dir, "documents")).withColumn("id", F.md5("summary"))


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _published(spark, sf_dir) -> str:
    """The folder of one day's outputs."""
    p = _identified(spark, sf_dir)
    day = F.lit(RUN_DATE).cast("date")
    root = _folder(spark, "daily")
    cfg = DailyConfig(run_date=RUN_DATE, topic_filter=True, keep_uncertain=True, preference=PREFERENCE, retries=0)
    daily_job(spark, p.where(F.col("date") == day).drop("date"), p.where(F.col("date") < day).select("id", "date"), cfg, root,
              summarize=brief, classify_fn=verdict, safety_fn=flagged, sleep=_no_pause)
    return root


CLASSIFY_SQL = """concat('Is this paper within the scope below? Answer with a JSON object (relevant, confidence, reason, topics).',
  chr(10), 'Scope: ', chr(10), chr(10), 'Paper: ', title, chr(10), 'By: ', authors, chr(10), 'Filed under: ',
  array_to_string(categories, ', '), chr(10), 'Remarks: ', '', chr(10), chr(10), summary)"""
BRIEF_SQL = "concat('Language: English', chr(10), 'Content:', chr(10), summary)"

FIELDS_SQL = "\n, ".join(f"CASE WHEN n % 11 = 0 THEN '{fixed.AI_DEFAULTS[name]}' ELSE {expr} END AS {name}" for name, expr in [
    ("tldr", "right(ask, 25)"), ("motivation", "concat(n, ' characters')"), ("method", "substring(ask, 21, 25)"),
    ("result", "CAST(n % 7 AS VARCHAR)"), ("conclusion", "'ok'")])

DAY_SQL = with_(PAPERS) + f"""
, ided AS (SELECT * REPLACE (md5(summary) AS id) FROM papers)
, today AS (SELECT *, {CLASSIFY_SQL} AS question FROM ided WHERE date = DATE '{RUN_DATE}')
, fresh AS (SELECT *, length(question) AS q FROM today WHERE NOT EXISTS (
    SELECT 1 FROM ided h WHERE h.id = today.id AND h.date BETWEEN DATE '{RUN_DATE}' - {fixed.LOOKBACK_DAYS} AND DATE '{RUN_DATE}' - 1))
, kept AS (SELECT * FROM fresh WHERE q % 13 <> 0 AND (q % 3 <> 0 OR q % 2 = 0)
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1)
, asked AS (SELECT *, {BRIEF_SQL} AS ask, length({BRIEF_SQL}) AS n FROM kept WHERE NOT contains(lower(summary), 'nicht'))
, told AS (SELECT *, {FIELDS_SQL}
           FROM asked)
, slice AS (SELECT * REPLACE ('English' AS language) FROM told
            WHERE NOT contains(lower(concat_ws(' ', tldr, motivation, method, result, conclusion)), 'nicht'))
"""
CODE_SQL = f"CASE WHEN {OWNER} IS NOT NULL THEN concat('{fixed.GITHUB_URL_PREFIX}', {OWNER}, '/', coalesce({REPO}, '')) ELSE {PAGES} END"


@register("c1_published_slice", DAY_SQL + f"""
SELECT id, title, strftime(date, '%Y-%m-%d') AS date, language, tldr, motivation, method, result, conclusion,
       {CODE_SQL} AS code_url, 0 AS code_stars
FROM (SELECT *, summary AS text FROM slice)""")
def c1_published_slice(spark, sf_dir):
    """The day's slice as a reader of the published feed gets it."""
    rows, _ = feed.read_feed(spark, f"{_published(spark, sf_dir)}/feed", mode="strict")
    return rows.select("id", "title", tf.iso_date("date").alias("date"), "language", "AI.tldr", "AI.motivation", "AI.method",
                       "AI.result", "AI.conclusion", "code_url", "code_stars")


MD_SQL = render_sql(fixed.DIGEST_ENTRY_TEMPLATE, idx="idx", title="title", url=f"concat('{fixed.ABS_URL_PREFIX}', id)",
                    authors="replace(authors, ', ', ',')", cate="primary_category", summary="summary",
                    tldr="tldr", motivation="motivation", method="method", result="result", conclusion="conclusion")


@register("c1_published_digest", DAY_SQL + f"""
, e AS (SELECT *, row_number() OVER (ORDER BY {CAT_RANK}, primary_category, seq, id) AS idx FROM slice)
, sections AS (SELECT primary_category, count(*) AS total, min(idx) AS first FROM e GROUP BY ALL)
, pieces AS (
  SELECT '{fixed.DIGEST_TOC_HEADER}' AS text WHERE EXISTS (SELECT 1 FROM e)
  UNION ALL SELECT {render_sql(fixed.DIGEST_TOC_LINE, cate="primary_category", count="total")} FROM sections
  UNION ALL SELECT {render_sql(fixed.DIGEST_SECTION_HEADER, cate="primary_category")} FROM sections
  UNION ALL SELECT CASE WHEN idx = first THEN '' ELSE '{fixed.DIGEST_ENTRY_SEPARATOR}' END || {MD_SQL}
            FROM e JOIN sections USING (primary_category))
, lines AS (SELECT unnest(string_split(substring(text, 1, length(text) - 1), chr(10))) AS line FROM pieces)
SELECT line, count(*) AS n FROM lines GROUP BY line""")
def c1_published_digest(spark, sf_dir):
    """The lines of the published digest, each with how often it stands there."""
    lines = spark.read.text(f"{_published(spark, sf_dir)}/digest")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("c1_published_manifest", DAY_SQL + """
SELECT DISTINCT concat(strftime(date, '%Y-%m-%d'), '_AI_enhanced_', language, '.jsonl') AS file FROM slice""")
def c1_published_manifest(spark, sf_dir):
    return spark.read.text(f"{_published(spark, sf_dir)}/file-list").select(F.col("value").alias("file"))


@register("m1_ledger_enrich", with_(PAPERS) + f"""
, asked AS (SELECT id, {BRIEF_SQL} AS ask, length({BRIEF_SQL}) AS n FROM papers)
SELECT id, CASE WHEN n % 11 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN n % 11 = 0 THEN 2 ELSE 1 END AS attempts, {FIELDS_SQL}
FROM asked""")
def m1_ledger_enrich(spark, sf_dir):
    """Summaries of all papers, called through a ledger and asked for twice:
    the second time only failed calls are made."""
    p = papers_view(load_table(spark, sf_dir, "documents"))
    path = _folder(spark, "ledger")
    for _ in range(2):
        e = infer.enrich(p, brief, retries=1, sleep=_no_pause, ledger_path=path)
    return e.select("id", "status", "attempts", *[f"AI.{f}" for f in fixed.AI_FIELDS])


@register("m2_ledger_classify", with_(PAPERS) + f"""
, asked AS (SELECT id, length({CLASSIFY_SQL}) AS n FROM papers)
SELECT id, n % 13 <> 0 AND (n % 3 <> 0 OR n % 2 = 0) AS relevant,
       CASE WHEN n % 13 = 0 THEN 0.0 WHEN n % 2 = 1 THEN 0.9 ELSE 0.4 END AS confidence,
       CASE WHEN n % 13 = 0 THEN '{fixed.TOPIC_DEFAULT_REASON}' WHEN n % 3 = 0 AND n % 2 = 0
            THEN concat('{fixed.UNCERTAIN_KEEP_PREFIX}', 'length ', n) ELSE concat('length ', n) END AS reason
FROM asked""")
def m2_ledger_classify(spark, sf_dir):
    p = papers_view(load_table(spark, sf_dir, "documents"))
    c = infer.classify(p, verdict, keep_uncertain=True, retries=0, sleep=_no_pause, ledger_path=_folder(spark, "ledger"))
    return c.select("id", "topic_filter.relevant", "topic_filter.confidence", "topic_filter.reason")


@register("m3_ledger_safety", """
SELECT DISTINCT sha256(text) AS text_hash, contains(lower(text), 'nicht') AS flagged FROM documents WHERE text IS NOT NULL""")
def m3_ledger_safety(spark, sf_dir):
    texts = load_table(spark, sf_dir, "documents").select("text")
    return infer.safety_verdicts(texts, flagged, retries=0, sleep=_no_pause, ledger_path=_folder(spark, "ledger"))
