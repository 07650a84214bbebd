"""Checked queries: tolerant JSON parsing of model output (X1-X5) and the
topic-filter rules (F10-F12, A6).

Model responses are derived from the tables by expression: ``events`` give
summary-shaped objects, ``labels`` give verdict-shaped objects; each row is
wrapped in one of eight ways (plain, fenced, text around, trailing text,
inside an array, garbage, empty, cut off) chosen by its key.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import jsonrepair as jr
from ..operators import topic
from ..session import apply_confs
from ..sources.tables import load_table
from .registry import register

N_WRAPS = 8


def wrap(body: Column, key: Column) -> Column:
    """Eight response shapes around a JSON object text ``body``."""
    k = (key % N_WRAPS).cast("int")
    return (F.when(k == 0, body)
            .when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```\nHope this helps.")))
            .when(k == 2, F.concat(F.lit("Result: "), body, F.lit(" -- done")))
            .when(k == 3, F.concat(body, F.lit(" trailing text")))
            .when(k == 4, F.concat(F.lit("["), body, F.lit("]")))
            .when(k == 5, F.lit("no json here"))
            .when(k == 6, F.lit(""))
            .otherwise(F.substring(body, 1, 5)))


def wrap_sql(body: str, key: str) -> str:
    return f"""CASE CAST({key} % {N_WRAPS} AS INTEGER)
      WHEN 0 THEN {body}
      WHEN 1 THEN concat('```json' || chr(10), {body}, chr(10) || '```' || chr(10) || 'Hope this helps.')
      WHEN 2 THEN concat('Result: ', {body}, ' -- done')
      WHEN 3 THEN concat({body}, ' trailing text')
      WHEN 4 THEN concat('[', {body}, ']')
      WHEN 5 THEN 'no json here'
      WHEN 6 THEN ''
      ELSE substring({body}, 1, 5) END"""


# DuckDB: the three candidates, first one that is a JSON object wins.
def first_object_sql(resp: str, required_key: str | None = None) -> str:
    t = f"trim(coalesce({resp}, ''))"
    fenced = f"nullif(trim(regexp_extract({t}, '(?is)```(?:json)?\\s*(.*?)```', 1)), '')"
    braces = (f"CASE WHEN strpos({t}, '{{') > 0 AND strpos({t}, '}}') > 0 "
              f"AND length({t}) - strpos(reverse({t}), '}}') + 1 > strpos({t}, '{{') "
              f"THEN substring({t}, strpos({t}, '{{'), length({t}) - strpos(reverse({t}), '}}') + 1 - strpos({t}, '{{') + 1) END")

    def ok(c):
        cond = f"coalesce(json_valid({c}), false) AND json_type({c}) = 'OBJECT'"
        if required_key:
            cond += f" AND json_exists({c}, '$.{required_key}')"
        return f"CASE WHEN {cond} THEN {c} END"
    return f"coalesce({ok(t)}, {ok(fenced)}, {ok(braces)})"


def _events(spark, sf_dir):
    apply_confs(spark)
    return load_table(spark, sf_dir, "events")


@register("x1_find_json", f"""
WITH r AS (SELECT event_id, {wrap_sql('props', 'event_id')} AS response FROM events),
p AS (SELECT event_id, {first_object_sql('response')} AS obj FROM r)
SELECT event_id, json_extract_string(obj, '$.k') AS k,
       CASE WHEN obj IS NULL THEN 'bad_json' ELSE 'ok' END AS parse_status
FROM p""")
def x1_find_json(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", wrap(F.col("props"), F.col("event_id")).alias("response"))
    m = jr.parse_object("response")
    return e.select("event_id", F.element_at(m, F.lit("k")).alias("k"),
                    F.when(m.isNull(), "bad_json").otherwise("ok").alias("parse_status"))


SUMMARY_BODY_SQL = ("concat('{\"tldr\": \"', event_type, '\", \"motivation\": \"user ', CAST(user_id AS VARCHAR), "
                    "'\", \"method\": ', CAST(value AS VARCHAR), ', \"result\": ', props, ', \"conclusion\": null}')")


def summary_body() -> Column:
    return F.concat(F.lit('{"tldr": "'), F.col("event_type"), F.lit('", "motivation": "user '),
                    F.col("user_id").cast("string"), F.lit('", "method": '), F.col("value").cast("string"),
                    F.lit(', "result": '), F.col("props"), F.lit(', "conclusion": null}'))


def _ai_sql(obj: str, failed: str = "false") -> str:
    cols = []
    for f in fixed.AI_FIELDS:
        d = fixed.AI_DEFAULTS[f]
        cols.append(f"CASE WHEN {failed} THEN '{d}' "
                    f"ELSE coalesce(json_extract_string({obj}, '$.{f}'), '{d}') END AS {f}")
    cols.append(f"CASE WHEN {failed} THEN 'error' WHEN {obj} IS NULL THEN 'bad_json' ELSE 'ok' END AS parse_status")
    return ",\n       ".join(cols)


@register("x2_ai_fields", f"""
WITH r AS (SELECT event_id, {wrap_sql(SUMMARY_BODY_SQL, 'event_id')} AS response FROM events),
p AS (SELECT event_id, {first_object_sql('response')} AS obj FROM r)
SELECT event_id, {_ai_sql('obj')} FROM p""")
def x2_ai_fields(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", wrap(summary_body(), F.col("event_id")).alias("response"))
    return jr.with_ai(e, "response", out="ai").select("event_id", "ai.*")


@register("x5_failure_defaults", f"""
WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
                  {wrap_sql(SUMMARY_BODY_SQL, 'event_id')} AS response FROM events),
p AS (SELECT event_id, status, {first_object_sql('response')} AS obj FROM r)
SELECT event_id, {_ai_sql('obj', "status = 'error'")} FROM p""")
def x5_failure_defaults(spark, sf_dir):
    e = _events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        wrap(summary_body(), F.col("event_id")).alias("response"))
    return jr.with_ai(e, "response", "status", out="ai").select("event_id", "ai.*")


PARTS_SQL = ("concat('[{\"type\": \"text\", \"text\": \"', event_type, '\"}, \"', CAST(user_id AS VARCHAR), "
             "'\", {\"type\": \"image\"}]')")


@register("x4_flatten_parts", f"""
WITH r AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN {PARTS_SQL} ELSE props END AS content FROM events)
SELECT event_id,
       CASE WHEN starts_with(trim(content), '[') AND json_valid(content)
            THEN array_to_string(list_transform(CAST(json_extract(content, '$[*]') AS JSON[]),
                   lambda p: CASE WHEN json_type(p) = 'OBJECT' THEN coalesce(json_extract_string(p, '$.text'), '')
                                  ELSE json_extract_string(p, '$') END), '')
            ELSE content END AS flat
FROM r""")
def x4_flatten_parts(spark, sf_dir):
    e = _events(spark, sf_dir)
    parts = F.concat(F.lit('[{"type": "text", "text": "'), F.col("event_type"), F.lit('"}, "'),
                     F.col("user_id").cast("string"), F.lit('", {"type": "image"}]'))
    c = F.when(F.col("event_id") % 2 == 0, parts).otherwise(F.col("props"))
    return e.select("event_id", jr.flatten_parts(c).alias("flat"))


# Verdict-shaped responses from labels.
VERDICT_BODY_SQL = """concat('{"relevant": ', CASE WHEN doc_id % 11 = 3 THEN '"false"' WHEN quality = 1 THEN 'true' ELSE 'false' END,
  ', "confidence": ', CASE WHEN doc_id % 13 = 5 THEN '"high"' ELSE CAST(round(0.3 + toxic * 0.5 + (doc_id % 5) / 10.0, 2) AS VARCHAR) END,
  ', "reason": "quality ', CAST(quality AS VARCHAR), '", "topics": ',
  CASE WHEN doc_id % 7 = 2 THEN '"single"' ELSE concat('["t', CAST(doc_id % 3 AS VARCHAR), '", "x", "y", "z", "a", "b", "c", "d", "e"]') END,
  '}')"""


def verdict_body() -> Column:
    d = F.col("doc_id")
    rel = F.when(d % 11 == 3, F.lit('"false"')).when(F.col("quality") == 1, F.lit("true")).otherwise(F.lit("false"))
    conf = F.when(d % 13 == 5, F.lit('"high"')).otherwise(
        F.round(F.lit(0.3) + F.col("toxic") * 0.5 + (d % 5) / 10.0, 2).cast("string"))
    topics = F.when(d % 7 == 2, F.lit('"single"')).otherwise(
        F.concat(F.lit('["t'), (d % 3).cast("string"), F.lit('", "x", "y", "z", "a", "b", "c", "d", "e"]')))
    return F.concat(F.lit('{"relevant": '), rel, F.lit(', "confidence": '), conf,
                    F.lit(', "reason": "quality '), F.col("quality").cast("string"), F.lit('", "topics": '),
                    topics, F.lit("}"))


def _labels(spark, sf_dir):
    apply_confs(spark)
    lb = load_table(spark, sf_dir, "labels")
    return lb.select("doc_id", wrap(verdict_body(), F.col("doc_id")).alias("response"))


def _verdict_sql(obj: str) -> str:
    rel = f"lower(trim(json_extract_string({obj}, '$.relevant')))"
    relb = (f"CASE WHEN {rel} = 'true' THEN true WHEN {rel} = 'false' THEN false "
            f"WHEN TRY_CAST({rel} AS DOUBLE) IS NOT NULL THEN TRY_CAST({rel} AS DOUBLE) <> 0 ELSE false END")
    conf = f"coalesce(TRY_CAST(json_extract_string({obj}, '$.confidence') AS DOUBLE), 0.0)"
    topics = (f"CASE WHEN json_type({obj}, '$.topics') = 'ARRAY' "
              f"THEN list_transform(CAST(json_extract({obj}, '$.topics') AS VARCHAR[])[1:8], lambda t: substring(t, 1, 80)) "
              f"ELSE []::VARCHAR[] END")
    reason = f"substring(coalesce(json_extract_string({obj}, '$.reason'), ''), 1, 500)"
    return f"""CASE WHEN {obj} IS NULL THEN false ELSE {relb} END AS relevant,
       CASE WHEN {obj} IS NULL THEN 0.0 ELSE {conf} END AS confidence,
       CASE WHEN {obj} IS NULL THEN '{fixed.TOPIC_DEFAULT_REASON}' ELSE {reason} END AS reason,
       CASE WHEN {obj} IS NULL THEN []::VARCHAR[] ELSE {topics} END AS topics,
       CASE WHEN {obj} IS NULL THEN 'bad_json' ELSE 'ok' END AS parse_status"""


VERDICTS_SQL = f"""WITH r AS (SELECT doc_id, {wrap_sql(VERDICT_BODY_SQL, 'doc_id')} AS response FROM labels),
p AS (SELECT doc_id, {first_object_sql('response', 'relevant')} AS obj FROM r),
v AS (SELECT doc_id, {_verdict_sql('obj')} FROM p)
"""


@register("x3_validate_verdict", VERDICTS_SQL + """
SELECT doc_id, relevant, round(confidence, 6) AS confidence, reason, array_to_string(topics, '|') AS topics,
       parse_status FROM v""")
def x3_validate_verdict(spark, sf_dir):
    v = jr.with_verdict(_labels(spark, sf_dir), "response", out="v")
    return v.select("doc_id", "v.relevant", F.round("v.confidence", 6).alias("confidence"), "v.reason",
                    F.array_join("v.topics", "|").alias("topics"), "v.parse_status")


UNCERTAIN_SQL = VERDICTS_SQL + f"""
, u AS (SELECT doc_id,
          CASE WHEN NOT relevant AND confidence < {fixed.TOPIC_MIN_CONFIDENCE} AND parse_status <> 'error'
               THEN true ELSE relevant END AS relevant,
          CASE WHEN NOT relevant AND confidence < {fixed.TOPIC_MIN_CONFIDENCE} AND parse_status <> 'error'
               THEN concat('{fixed.UNCERTAIN_KEEP_PREFIX}', reason) ELSE reason END AS reason
        FROM v)
"""


def _classified(spark, sf_dir, keep=True):
    return topic.classify(_labels(spark, sf_dir), status_col=None, keep_uncertain_enabled=keep)


@register("f11_keep_uncertain", UNCERTAIN_SQL + "SELECT doc_id, relevant, reason FROM u")
def f11_keep_uncertain(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return c.select("doc_id", "topic_filter.relevant", "topic_filter.reason")


@register("f10_relevance_split", UNCERTAIN_SQL + """
SELECT doc_id, CASE WHEN relevant THEN 'kept' ELSE 'excluded' END AS side FROM u""")
def f10_relevance_split(spark, sf_dir):
    kept, excluded = topic.split(_classified(spark, sf_dir))
    return (kept.select("doc_id", F.lit("kept").alias("side"))
            .unionByName(excluded.select("doc_id", F.lit("excluded").alias("side"))))


@register("a6_filter_report", UNCERTAIN_SQL + """
SELECT CAST(count(*) FILTER (WHERE relevant) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE NOT relevant) AS BIGINT) AS excluded,
       CAST(count(*) AS BIGINT) AS total,
       CASE WHEN count(*) FILTER (WHERE relevant) = 0 AND count(*) > 0 THEN 2 ELSE 0 END AS status
FROM u""")
def a6_filter_report(spark, sf_dir):
    return topic.report(_classified(spark, sf_dir))


@register("f12_empty_guard", VERDICTS_SQL + """
SELECT CAST(count(*) FILTER (WHERE relevant AND confidence > 2) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE NOT (relevant AND confidence > 2)) AS BIGINT) AS excluded,
       CAST(count(*) AS BIGINT) AS total,
       CASE WHEN count(*) FILTER (WHERE relevant AND confidence > 2) = 0 AND count(*) > 0 THEN 2 ELSE 0 END
         AS status
FROM v""")
def f12_empty_guard(spark, sf_dir):
    """a strict run that keeps nothing reports status 2 (input left unchanged)."""
    c = topic.classify(_labels(spark, sf_dir), status_col=None, keep_uncertain_enabled=False)
    strict = c.withColumn("topic_filter", F.col("topic_filter").withField(
        "relevant", F.col("topic_filter.relevant") & (F.col("topic_filter.confidence") > 2)))
    return topic.report(strict)
