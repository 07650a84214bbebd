"""Tolerant parsing of model output (X1-X5), as built-in JSON expressions.

A response is searched for a JSON object in three places, in this order:
the whole trimmed text, the body of the first fenced block, and the span
from the first ``{`` to the last ``}``.  The first candidate that parses to an
object wins; text after a complete object is ignored.  ``from_json`` with a
``map<string,string>`` schema has exactly these properties: it stops after the
first value, and yields NULL for arrays, scalars, cut-off objects and garbage.
Single quotes are rejected (``allowSingleQuotes=false``) as a strict parser
would.  With a repeated key the last value wins (``get_last``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .text import _c

MAP_SCHEMA = "map<string,string>"
JSON_OPTIONS = {"allowSingleQuotes": "false"}


def flatten_parts(content: Column | str) -> Column:
    """Message content stored as a JSON list of parts -> its text.

    A part that is an object contributes its ``text`` field, anything else its
    own text.  Content that is not such a list passes through unchanged.  Use
    it on stored structured content only: a model's *text* answer that happens
    to be a JSON array is a response to parse, not a parts list.
    """
    c = _c(content)
    parts = F.from_json(c, "array<string>", JSON_OPTIONS)
    joined = F.array_join(F.transform(parts, lambda p: F.when(
        F.trim(p).startswith("{"), F.coalesce(F.get_json_object(p, "$.text"), F.lit(""))).otherwise(p)), "")
    return F.when(F.trim(c).startswith("[") & parts.isNotNull(), joined).otherwise(c)


def candidates(text: Column | str) -> list[Column]:
    """The three candidate texts, in the order they are tried."""
    t = F.trim(F.coalesce(_c(text), F.lit("")))
    fenced = F.trim(F.regexp_extract(t, fixed.FENCE_PATTERN, 1))
    start = F.instr(t, "{")
    end = F.length(t) - F.instr(F.reverse(t), "}") + 1
    braces = F.when((start > 0) & (F.instr(t, "}") > 0) & (end > start), F.substring(t, start, end - start + 1))
    return [t, F.nullif(fenced, F.lit("")), braces]


def parse_object(text: Column | str, required_key: str | None = None) -> Column:
    """First candidate that parses to a JSON object -> ``map<string,string>``.

    With ``required_key`` a candidate also needs that key (the verdict parser
    moves on to the next candidate otherwise).  NULL when nothing qualifies.
    """
    parsed = [F.from_json(c, MAP_SCHEMA, JSON_OPTIONS) for c in candidates(text)]
    if required_key is not None:
        parsed = [F.when(F.map_contains_key(p, F.lit(required_key)), p) for p in parsed]
    return F.coalesce(*parsed)


def get_last(m: Column, key: str) -> Column:
    """Value of ``key``; with a repeated key the last one wins, as in a JSON decoder
    (a parsed map keeps every entry and a plain lookup would return the first)."""
    return F.try_element_at(F.filter(F.map_entries(m), lambda e: e.getField("key") == key), F.lit(-1)) \
        .getField("value")


def field_or_default(m: Column, key: str, default: str) -> Column:
    """Value as text (nested values keep their JSON text); null or absent -> default."""
    return F.coalesce(get_last(m, key), F.lit(default))


def ai_fields(m: Column, status: Column | str | None = None) -> Column:
    """X2 + X5 from a parsed object ``m`` (see ``parse_object``).

    ``status`` comes from the batch call: a failed call (``error``) and an
    unparsable answer get the generation defaults; only a row whose own
    processing died (``failed``) gets the *Processing failed* set.  Returns ``struct<tldr, motivation, method, result, conclusion,
    parse_status>``.  ``m`` should be a column reference, so the parse runs once.
    """
    failed = F.lit(False) if status is None else _c(status).isin("error", "failed")
    died = F.lit(False) if status is None else (_c(status) == "failed")
    fields = []
    for f in fixed.AI_FIELDS:
        v = (F.when(died, F.lit(fixed.AI_PROCESSING_FAILED)).when(failed, F.lit(fixed.AI_DEFAULTS[f]))
             .otherwise(field_or_default(m, f, fixed.AI_DEFAULTS[f])))
        fields.append(v.alias(f))
    pstat = F.when(failed, F.lit("error")).when(m.isNull(), F.lit("bad_json")).otherwise(F.lit("ok"))
    return F.struct(*fields, pstat.alias("parse_status"))


def text_bool(v: Column) -> Column:
    """Q7: JSON booleans and the texts true/false; numbers by non-zero; other text false."""
    s = F.lower(F.trim(v))
    d = s.try_cast("double")
    return F.when(s == "true", True).when(s == "false", False).when(d.isNotNull(), d != 0).otherwise(False)


def verdict_fields(m: Column, status: Column | str | None = None) -> Column:
    """X3 + X5 from a parsed object ``m`` (parsed with ``required_key='relevant'``).

    Confidence must be a number else 0; topics must be a list, first 8 kept,
    each cut to 80 characters; reason cut to 500.  Bad JSON and failed calls
    give the fail-closed default verdict.  Returns ``struct<relevant,
    confidence, reason, topics, parse_status>``.
    """
    failed = F.lit(False) if status is None else (_c(status) == "error")
    ok = m.isNotNull() & ~failed
    conf = F.coalesce(get_last(m, "confidence").try_cast("double"), F.lit(0.0))
    topics_raw = F.from_json(get_last(m, "topics"), "array<string>", JSON_OPTIONS)
    topics = F.transform(F.slice(F.coalesce(topics_raw, F.array().cast("array<string>")), 1, fixed.TOPIC_MAX_TOPICS),
                         lambda t: F.substring(F.coalesce(t, F.lit("")), 1, fixed.TOPIC_MAX_TOPIC_CHARS))
    reason = F.substring(F.coalesce(get_last(m, "reason"), F.lit("")), 1, fixed.TOPIC_MAX_REASON_CHARS)
    return F.struct(
        F.when(ok, text_bool(get_last(m, "relevant"))).otherwise(F.lit(False)).alias("relevant"),
        F.when(ok, conf).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(ok, reason).otherwise(F.lit(fixed.TOPIC_DEFAULT_REASON)).alias("reason"),
        F.when(ok, topics).otherwise(F.array().cast("array<string>")).alias("topics"),
        F.when(failed, F.lit("error")).when(m.isNull(), F.lit("bad_json")).otherwise(F.lit("ok")).alias("parse_status"),
    )


def with_ai(df: DataFrame, response_col: str = "response", status_col: str | None = None,
            out: str = "AI") -> DataFrame:
    """Parse model summaries into ``out`` (X1, X2, X5) in two projections:
    the object is parsed once into a map column, the fields read from it."""
    st = status_col if status_col and status_col in df.columns else None
    return (df.withColumn("_obj", parse_object(response_col))
            .withColumn(out, ai_fields(F.col("_obj"), st)).drop("_obj"))


def with_verdict(df: DataFrame, response_col: str = "response", status_col: str | None = None,
                 out: str = "topic_filter") -> DataFrame:
    """Parse classifier verdicts into ``out`` (X1, X3, X5), staged like ``with_ai``."""
    st = status_col if status_col and status_col in df.columns else None
    return (df.withColumn("_obj", parse_object(response_col, required_key="relevant"))
            .withColumn(out, verdict_fields(F.col("_obj"), st)).drop("_obj"))
