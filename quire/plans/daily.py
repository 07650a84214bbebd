"""The daily pipeline as one Spark job per day.

ingest -> metadata fill -> look-back dedup (+ report, stop conditions) ->
topic filter (optional) -> first-seen distinct -> safety gate -> code links
-> summary enrichment -> publish (feed slice, digest, manifest).

Model calls go through the ledger (``operators/ledger.py``) where a folder for
it is given: a finished call is kept as soon as its task ends and no later run
of the day, or of another day with the same prompt, makes it again.  So a
killed run is resumed by running the day again, and ``publish`` replaces the
day's outputs as a whole, slice by slice.  Without a ledger, answers are
checkpointed right after the calls.  Shuffles: dedup (id), first-seen (id), the
verdict lookups (text hash), the prompts (hash), the digest numbering.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import dedup, digest, fill, infer, topic
from ..session import materialize
from ..sources import feed

TOPIC_EMPTY = "topic_empty"


@dataclass
class DailyConfig:
    run_date: str
    language: str = "English"
    preference: list[str] = field(default_factory=lambda: list(fixed.DEFAULT_PREFERRED_CATEGORIES))
    lookback_days: int = fixed.LOOKBACK_DAYS
    topic_filter: bool = False
    keep_uncertain: bool = False
    min_confidence: float = fixed.TOPIC_MIN_CONFIDENCE
    call_partitions: int | None = None     # bounds concurrent model calls
    retries: int = fixed.RETRIES
    ledger: str | None = None              # shared folder of finished calls
    model: str = "model"                   # whose answers these are (part of a call's key)


@dataclass
class DailyResult:
    status: str                      # has_new_content / no_new_content / no_data / topic_empty
    report: DataFrame | None = None
    published: DataFrame | None = None
    excluded: DataFrame | None = None
    quarantine: DataFrame | None = None
    digest_lines: DataFrame | None = None


def run_daily(today: DataFrame, history: DataFrame, cfg: DailyConfig,
              summarize: Callable[[str], object], classify_fn: Callable[[str], object] | None = None,
              safety_fn: Callable[[str], object] | None = None,
              metadata: DataFrame | None = None, repo_stats: DataFrame | None = None,
              sleep=None) -> DailyResult:
    """Run one day.  ``today`` holds the crawled rows of ``cfg.run_date``
    (``id, seq, title, summary, authors, categories, ...``); ``history`` the
    stored rows of earlier days (``id, date``)."""
    kw = {"retries": cfg.retries, "partitions": cfg.call_partitions, "ledger_path": cfg.ledger}
    if sleep is not None:
        kw["sleep"] = sleep

    def verdicts(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
        return materialize(infer.safety_verdicts(infer.scored_texts(rows, fields), safety_fn, label=f"safety:{cfg.model}", **kw))

    day = today.withColumn("date", F.lit(cfg.run_date).cast("date"))
    if metadata is not None:
        day = fill.fill_metadata(day, metadata)
    both = day.select("id", "date").unionByName(history.select("id", "date"))
    report = dedup.dedup_report(both, cfg.run_date, cfg.lookback_days)
    status = report.select("status").first()[0]
    if status != fixed.STATUS_HAS_NEW:
        return DailyResult(status, report)
    fresh = dedup.lookback_antijoin(day, cfg.run_date, cfg.lookback_days, history=history)

    excluded = None
    if cfg.topic_filter and classify_fn is not None:
        classified = materialize(infer.classify(fresh, classify_fn, keep_uncertain=cfg.keep_uncertain,
                                                min_confidence=cfg.min_confidence, label=f"classify:{cfg.model}", **kw))
        kept, excluded = topic.split(classified, materialized=True)
        if kept.isEmpty():
            return DailyResult(TOPIC_EMPTY, report, excluded=excluded)
        fresh = kept

    rows = dedup.first_seen(fresh, "id", "seq")
    quarantine = None
    if safety_fn is not None:
        rows, quarantine = fill.safety_gate(rows, verdicts(rows, ("summary",)), fields=("summary",))
    rows = fill.code_links(rows, repo_stats, "summary")
    enriched = materialize(infer.enrich(rows, summarize, language=cfg.language, label=f"enrich:{cfg.model}:{cfg.language}", **kw))
    if safety_fn is not None:
        produced = tuple(f"AI.{f}" for f in fixed.AI_FIELDS)
        enriched, q2 = fill.safety_gate(enriched, verdicts(enriched, produced), fields=produced)
        quarantine = q2 if quarantine is None else quarantine.unionByName(q2)
    published = feed.normalize(enriched).withColumn("language", F.lit(cfg.language))
    lines = digest.digest_lines(published, cfg.preference)
    return DailyResult(fixed.STATUS_HAS_NEW, report, published, excluded, quarantine, lines)


def publish(spark: SparkSession, result: DailyResult, cfg: DailyConfig, root: str) -> bool:
    """Write a day's outputs under ``root``: ``feed`` (the day's slice),
    ``excluded``, ``quarantine``, ``digest`` and, last, ``file-list`` (S11), which
    readers go by.  Each write replaces this day's part and no other day's, so a
    run that died in between is put right by the next.  Nothing is written where
    the day has nothing to publish; whether it has is returned."""
    root = root.rstrip("/")
    if result.excluded is not None:
        feed.write_feed(result.excluded, f"{root}/excluded")
    if result.published is None:
        return False
    feed.write_feed(result.published, f"{root}/feed")
    if result.quarantine is not None:
        feed.write_feed(result.quarantine.withColumn("date", F.lit(cfg.run_date).cast("date")), f"{root}/quarantine")
    digest.write_digest(result.digest_lines, f"{root}/digest")
    feed.write_manifest(feed.list_files(spark, f"{root}/feed"), f"{root}/file-list")
    return True


def daily_job(spark: SparkSession, today: DataFrame, history: DataFrame, cfg: DailyConfig, root: str, **functions) -> DailyResult:
    """``run_daily`` and ``publish``, with the ledger beside the outputs unless
    ``cfg`` names another; run it again after a failure and it goes on."""
    if cfg.ledger is None:
        cfg.ledger = f"{root.rstrip('/')}/ledger"
    result = run_daily(today, history, cfg, **functions)
    publish(spark, result, cfg, root)
    return result
