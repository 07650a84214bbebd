"""Batch calls to a user-supplied model function (M1 enrich, M2 classify,
M3 safety score) and prompt rendering (P16).

No network client ships with the package: the caller passes a Python
function ``prompt -> response``.  Spark partitions the rows; each task calls
the function for its rows through ``mapInPandas`` (Arrow batches), with
bounded retries, exponential backoff with jitter and an optional start
stagger.  Concurrency is the number of partitions (``repartition(n)``) times
the optional threads per task, which bounds the load on the service.

Each distinct prompt is called once and its answer joined back to every row
that asked for it, so repeated or null ids neither pay twice nor multiply
rows.  A failed call never loses its row: it comes back with ``status =
'error'`` and the parsers give it the generation defaults (X5).  With a
ledger (``ledger.py``) every finished call is kept in a table keyed by prompt
hash as soon as its task ends, and a re-run only makes the calls that have no
good answer yet.
"""
from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import render
from . import ledger

RESULT_SCHEMA = "{key} string, response string, kind string, status string, attempts int, error string"


def render_prompt(template: str, **slots: Column | str) -> Column:
    """Fill a template's ``{slot}`` names; array slots are joined with ', '."""
    cols = {}
    for k, v in slots.items():
        c = F.col(v) if isinstance(v, str) else v
        cols[k] = c
    return render(template, **cols)


def list_slot(c: Column | str) -> Column:
    """A list slot of a prompt: items joined with ', ' (empty list -> '')."""
    return F.coalesce(F.array_join(F.col(c) if isinstance(c, str) else c, ", "), F.lit(""))


def backoff(retries: int, base: float, cap: float, rng: random.Random) -> Iterator[float]:
    """The pauses between attempts: doubling from ``base`` up to ``cap``, each
    with a random addition of at most ``base`` (or the pause itself)."""
    base = max(0.1, base)
    pause = base
    for _ in range(retries):
        pause = min(pause, max(base, cap))
        yield pause + rng.uniform(0, min(base, pause))
        pause *= 2


def call_with_retries(fn: Callable[[str], object], prompt: str, retries: int = fixed.RETRIES,
                      base: float = fixed.RETRY_BASE_SECONDS, cap: float = fixed.RETRY_MAX_SECONDS,
                      stagger: float = 0.0, sleep: Callable[[float], None] = time.sleep,
                      rng: random.Random | None = None) -> tuple[object, int]:
    """``(result, attempts)`` of the first attempt that succeeds, pausing by
    ``backoff`` after each failure; the last error is raised when none does."""
    rng = rng or random.Random()
    pauses = backoff(max(0, retries), base, cap, rng)
    if stagger > 0:
        sleep(rng.uniform(0, stagger))
    for attempt in itertools.count(1):
        try:
            return fn(prompt), attempt
        except Exception:
            pause = next(pauses, None)
            if pause is None:
                raise
        sleep(pause)


#: How an answer's type is stored: its text form and the kind that tells the
#: parsers how to read it (parts are joined on the JVM side).
ANSWER_KINDS = (((str,), "text"), ((list, tuple), "parts"), ((dict, bool, int, float, type(None)), "json"))


def answer_text(result: object) -> tuple[str, str]:
    """``(text, kind)`` of an answer, or of its ``content`` where it is a message."""
    if not isinstance(result, str):
        result = getattr(result, "content", result)
    kind = next((k for types, k in ANSWER_KINDS if isinstance(result, types)), "text")
    return (str(result) if kind == "text" else json.dumps(result, ensure_ascii=False, default=str)), kind


def batch_call(df: DataFrame, fn: Callable[[str], object], prompt: Column | str, key: str = "id",
               partitions: int | None = None, threads: int = 1, retries: int = fixed.RETRIES,
               base: float = fixed.RETRY_BASE_SECONDS, cap: float = fixed.RETRY_MAX_SECONDS,
               stagger: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """M1 / M2 / M3 driver: ``(key, response, kind, status, attempts, error)`` per input row."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    src = df.select(F.col(key).cast("string").alias(key), p.alias("_prompt"))
    if partitions:
        src = src.repartition(partitions)

    def one(pr: str) -> tuple:
        try:
            res, n = call_with_retries(fn, pr, retries, base, cap, stagger, sleep)
            text, kind = answer_text(res)
            return text, kind, "ok", n, None
        except Exception as e:  # failure never loses the row
            return None, None, "error", retries + 1, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = None
        if threads > 1:
            from concurrent.futures import ThreadPoolExecutor
            pool = ThreadPoolExecutor(max_workers=threads)
        try:
            for b in batches:
                prompts = b["_prompt"].tolist()
                res = list(pool.map(one, prompts)) if pool else [one(x) for x in prompts]  # order kept
                out = pd.DataFrame(res, columns=["response", "kind", "status", "attempts", "error"])
                out.insert(0, key, b[key].values)
                out["attempts"] = out["attempts"].astype("int32")
                yield out
        finally:
            if pool:
                pool.shutdown()

    return src.mapInPandas(run, RESULT_SCHEMA.format(key=key))


CALL_COLUMNS = ("response", "kind", "status", "attempts", "error")


def _without_call_columns(df: DataFrame) -> DataFrame:
    """Drop the bookkeeping of an earlier call before joining a new one."""
    return df.drop(*[c for c in CALL_COLUMNS if c in df.columns])


def answers_to(each: DataFrame, fn: Callable[[str], object], ledger_path: str | None, label: str, **kw) -> DataFrame:
    """Answers for distinct prompts ``(_ask_hash, _ask)``: called now, or
    (with a ledger) taken from the ledger and called only where it has none."""
    if ledger_path is None:
        return batch_call(each, fn, "_ask", key=ledger.HASH, **kw)
    tasks = kw.pop("partitions", None)
    return ledger.answered(each, ledger_path, label, lambda rows: batch_call(rows, fn, "_ask", key=ledger.HASH, **kw), tasks=tasks)


def call_rows(df: DataFrame, fn: Callable[[str], object], prompt: Column, ledger_path: str | None = None,
              label: str = "call", **kw) -> DataFrame:
    """Every row of ``df`` with its answer's columns; one call a distinct prompt.

    Answers are unique by prompt hash, so the join keeps the row count.  With
    ``ledger_path`` finished calls are kept there under ``label`` (what is
    asked of which model) and never made again."""
    asked = _without_call_columns(df).withColumn("_ask", F.coalesce(prompt, F.lit(""))).withColumn(ledger.HASH, ledger.ask_hash(label, "_ask"))
    each = asked.select(ledger.HASH, "_ask").dropDuplicates([ledger.HASH])
    answers = answers_to(each, fn, ledger_path, label, **kw).withColumn("response", response_text())
    return asked.drop("_ask").join(answers, ledger.HASH, "left").drop(ledger.HASH)


def response_text() -> Column:
    """X4 applied where the function answered with message parts."""
    from ..functions.jsonrepair import flatten_parts
    return F.when(F.col("kind") == "parts", flatten_parts("response")).otherwise(F.col("response"))


def enrich(df: DataFrame, fn: Callable[[str], object], language: str = "English", key: str = "id",
           template: str = "Language: {language}\nContent:\n{content}", label: str = "enrich", **kw) -> DataFrame:
    """M1: first-seen distinct rows (W1) -> prompt -> call -> ``AI`` struct."""
    from ..functions.jsonrepair import with_ai
    from .dedup import first_seen
    rows = first_seen(_without_call_columns(df), key, "seq" if "seq" in df.columns else None)
    prompt = render_prompt(template, language=F.lit(language), content="summary")
    out = call_rows(rows, fn, prompt, label=label, **kw).withColumn(key, F.col(key).cast("string"))
    return with_ai(out, "response", "status").drop("response", "kind")


#: Default question of the topic classifier; ``scope`` says what is wanted.
CLASSIFY_TEMPLATE = ("Is this paper within the scope below? Answer with a JSON object (relevant, confidence, reason, topics).\n"
                     "Scope: {scope}\n\nPaper: {title}\nBy: {authors}\nFiled under: {categories}\nRemarks: {comment}\n\n{summary}")


def classify_prompt(df: DataFrame, scope: str = "", template: str = CLASSIFY_TEMPLATE) -> Column:
    """The classifier's question for each row of ``df``."""
    comment = F.coalesce(F.col("comment"), F.lit("")) if "comment" in df.columns else F.lit("")
    return render_prompt(template, scope=F.lit(scope), title="title", categories=list_slot("categories"),
                         authors=list_slot("authors"), comment=comment, summary="summary")


def classify(df: DataFrame, fn: Callable[[str], object], key: str = "id", keep_uncertain: bool = False,
             min_confidence: float = fixed.TOPIC_MIN_CONFIDENCE, scope: str = "", template: str = CLASSIFY_TEMPLATE,
             label: str = "classify", **kw) -> DataFrame:
    """M2: prompt -> call -> verdict (fail-closed) -> keep-uncertain rule; one row out per row in."""
    from . import topic
    out = call_rows(df, fn, classify_prompt(df, scope, template), label=label, **kw).withColumn(key, F.col(key).cast("string"))
    return topic.classify(out, "response", "status", keep_uncertain, min_confidence).drop("response", "kind")


def safety_verdicts(texts: DataFrame, fn: Callable[[str], object], text_col: str = "text",
                    ledger_path: str | None = None, label: str = "safety", **kw) -> DataFrame:
    """M3: score each *distinct* text once -> ``(text_hash, flagged)``.

    Only an explicit ``True`` (or ``{"sensitive": true}``) flags a text;
    errors and anything else do not (fail-open).
    """
    from .fill import text_hash
    # Distinct by hash: the shuffle key is 64 characters, not the whole text.
    d = (texts.select(F.col(text_col).alias("_ask")).where(F.col("_ask").isNotNull())
         .withColumn("text_hash", text_hash("_ask")).dropDuplicates(["text_hash"]).withColumn(ledger.HASH, ledger.ask_hash(label, "_ask")))
    answers = answers_to(d.select(ledger.HASH, "_ask"), fn, ledger_path, label, **kw)
    res = d.select("text_hash", ledger.HASH).join(answers, ledger.HASH)
    flagged = (F.col("status") == "ok") & (
        (F.lower(F.trim("response")) == "true")
        | F.coalesce(F.get_json_object("response", "$.sensitive") == "true", F.lit(False)))
    return res.select("text_hash", flagged.alias("flagged"))


def scored_texts(df: DataFrame, fields: Sequence[str] = ("summary",) + tuple(f"AI.{f}" for f in fixed.AI_FIELDS)
                 ) -> DataFrame:
    """All texts of the given fields, one column ``text`` (input of M3)."""
    present = [f for f in fields if f.split(".")[0] in df.columns]
    return df.select(F.explode(F.array(*[F.col(f) for f in present])).alias("text"))
