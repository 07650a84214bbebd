"""Checked queries: batch model calls (M1-M3, rows-only: a user function is
not SQL) and prompt rendering (P16, with oracle).

The model function used here is local and deterministic: it answers every
prompt with a JSON object built from the prompt text, and fails on purpose
for some prompts so the error path (retries exhausted, defaults) runs too.
"""
from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import infer
from ..session import apply_confs
from ..sources.tables import enriched_view, load_table, papers_view
from .oracle_views import PAPERS, with_
from .registry import register


def local_summarizer(prompt: str) -> str:
    """Deterministic stand-in for a hosted model (fails when the prompt mentions 'zz')."""
    if "zz" in prompt:
        raise RuntimeError("service unavailable")
    words = prompt.split()
    body = {"tldr": " ".join(words[2:10]), "motivation": f"{len(words)} words", "method": words[-1] if words else "",
            "result": str(len(prompt)), "conclusion": "ok"}
    if len(words) % 3 == 0:
        return "```json\n" + json.dumps(body) + "\n```"
    return json.dumps(body)


def local_classifier(prompt: str) -> str:
    rel = "ouen" in prompt.lower()
    conf = 0.9 if "the" in prompt else 0.4
    return json.dumps({"relevant": rel, "confidence": conf, "reason": "keyword rule", "topics": ["feed"]})


def local_safety(text: str) -> bool:
    return "nicht" in text.lower()


def _no_sleep(_s: float) -> None:
    return None


@register("m1_batch_enrich")
def m1_batch_enrich(spark, sf_dir):
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents"))
    e = infer.enrich(p, local_summarizer, language="English", retries=1, sleep=_no_sleep)
    return e.select("id", "AI.tldr", "AI.parse_status", "status", "attempts")


@register("m2_batch_classify")
def m2_batch_classify(spark, sf_dir):
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents"))
    c = infer.classify(p, local_classifier, keep_uncertain=True, sleep=_no_sleep)
    return c.select("id", "topic_filter.relevant", "topic_filter.confidence", "topic_filter.reason", "status")


@register("m3_batch_safety")
def m3_batch_safety(spark, sf_dir):
    apply_confs(spark)
    e = enriched_view(load_table(spark, sf_dir, "documents"))
    return infer.safety_verdicts(infer.scored_texts(e), local_safety, sleep=_no_sleep)


@register("p16_prompt_render", with_(PAPERS) + """
SELECT id, concat('Is this paper within the scope below? Answer with a JSON object (relevant, confidence, reason, topics).',
                  chr(10), 'Scope: robots', chr(10), chr(10), 'Paper: ', title, chr(10), 'By: ', authors, chr(10),
                  'Filed under: ', array_to_string(categories, ', '), chr(10), 'Remarks: ', '', chr(10), chr(10), summary)
       AS prompt
FROM papers""")
def p16_prompt_render(spark, sf_dir):
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents"))
    return p.select("id", infer.classify_prompt(p, scope="robots").alias("prompt"))


@register("c1_daily_run")
def c1_daily_run(spark, sf_dir):
    """One day through fill, dedup, topic filter, safety gate, enrichment and
    digest (rows-only: model functions are Python).  Paper ids are content
    hashes, so exact copies from earlier days are removed by the look-back."""
    from ..plans.daily import DailyConfig, run_daily
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents")).withColumn("id", F.md5("summary"))
    run = "2024-01-15"
    today = p.where(F.col("date") == F.lit(run).cast("date")).drop("date")
    history = p.where(F.col("date") < F.lit(run).cast("date")).select("id", "date")
    r = run_daily(today, history, DailyConfig(run_date=run, topic_filter=True, keep_uncertain=True),
                  local_summarizer, local_classifier, local_safety, sleep=_no_sleep)
    return r.published.select("id", "title", "primary_category", F.col("AI.tldr").alias("tldr"))
