"""Topic filter: verdict rules, relevance split, report and split sink
(F10, F11, F12, A6, S9).

Verdicts come from ``functions.jsonrepair.with_verdict`` (parsed model
output, fail-closed defaults).  The keep-uncertain rule flips a rejection
whose confidence is under the minimum; bad JSON has confidence 0 and so can
be rescued, a failed call cannot (Q8: ``parse_status`` tells which).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import materialize
from . import versions

STATUS_OK = 0
STATUS_EMPTY = 2     # nothing kept: input left unchanged


def keep_uncertain(verdict: Column | str, enabled: bool = True,
                   min_confidence: float = fixed.TOPIC_MIN_CONFIDENCE) -> Column:
    """a rejection under ``min_confidence`` is kept, reason prefixed."""
    v = F.col(verdict) if isinstance(verdict, str) else verdict
    if not enabled:
        return v
    flip = (~v.getField("relevant")) & (v.getField("confidence") < F.lit(min_confidence)) \
        & (v.getField("parse_status") != "error")
    return F.when(flip, v.withField("relevant", F.lit(True)).withField(
        "reason", F.concat(F.lit(fixed.UNCERTAIN_KEEP_PREFIX), v.getField("reason")))).otherwise(v)


def classify(df: DataFrame, response_col: str = "response", status_col: str | None = "status",
             keep_uncertain_enabled: bool = False,
             min_confidence: float = fixed.TOPIC_MIN_CONFIDENCE) -> DataFrame:
    """Attach ``topic_filter`` (the verdict struct) to every row.

    Parsing, field extraction and the keep-uncertain rule are separate
    projections over column references, so no expression is evaluated twice.
    """
    from ..functions.jsonrepair import with_verdict
    v = with_verdict(df, response_col, status_col, out="_verdict")
    return (v.withColumn("topic_filter", keep_uncertain("_verdict", keep_uncertain_enabled, min_confidence))
            .drop("_verdict"))


def split(classified: DataFrame, materialized: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) by the verdict.

    The verdicts are checkpointed first (unless the caller already did):
    they stem from paid calls, both outputs read them, and a filter on a
    parsed field must not be pushed back into the parsing expressions (the
    optimizer would inline the whole parse into the predicate).
    """
    c = classified if materialized else materialize(classified)
    rel = F.col("topic_filter.relevant")
    return c.where(rel), c.where(~rel)


def report(classified: DataFrame) -> DataFrame:
    """A6 + F12: kept / excluded / total and the run status, in one aggregation."""
    r = classified.agg(F.count_if(F.col("topic_filter.relevant")).cast("long").alias("kept"),
                       F.count_if(~F.col("topic_filter.relevant")).cast("long").alias("excluded"),
                       F.count(F.lit(1)).cast("long").alias("total"))
    return r.withColumn("status", F.when((F.col("kept") == 0) & (F.col("total") > 0), F.lit(STATUS_EMPTY))
                        .otherwise(F.lit(STATUS_OK)))


def write_split(classified: DataFrame, root: str, partition_cols: tuple[str, ...] = ("date",)) -> int:
    """S9 + F12: write kept and excluded rows, each with its verdict, so that
    readers (``read_split``) see both of a run or neither.

    Both outputs are written to a new version's folder from one checkpoint of
    the classified rows (paid verdicts are never recomputed); the pointer that
    says which version holds which day is switched last.  A failure before that
    leaves the old pair as it was; other days keep their versions.  When nothing
    is kept nothing is written and status 2 is returned."""
    kept, excluded = split(classified)
    if kept.isEmpty():
        return STATUS_EMPTY
    spark = classified.sparkSession
    parts = [p for p in partition_cols if p in kept.columns]
    version = versions.new_version()
    for rows, name in ((kept, "kept"), (excluded, "excluded")):
        w = rows.write.partitionBy(*parts) if parts else rows.write
        w.parquet(versions.folder(root, version, name))
    # A day belongs to this run whichever of the two outputs has rows of it.
    days = [r[0] for r in classified_days(kept, excluded, parts)]
    versions.switch(spark, root, {d: version for d in days})
    return STATUS_OK


def classified_days(kept: DataFrame, excluded: DataFrame, parts: list[str]) -> list:
    """The days of a run (a calendar-bounded list; one name without a day column)."""
    if not parts:
        return [(versions.WHOLE,)]
    day = F.col(parts[0]).cast("string").alias("day")
    return kept.select(day).union(excluded.select(day)).distinct().where(F.col("day").isNotNull()).collect()


def read_split(spark: SparkSession, root: str, name: str = "kept", partition_col: str = "date") -> DataFrame | None:
    """One output (``kept`` or ``excluded``) as the pointer has it; None before
    the first run.  Each version's files are pruned to the days it holds."""
    by_version: dict[str, list[str]] = {}
    for day, version in versions.current(spark, root).items():
        by_version.setdefault(version, []).append(day)
    out = None
    for version, days in sorted(by_version.items()):
        path = versions.folder(root, version, name)
        if not versions.has_rows(spark, path):
            continue
        rows = spark.read.parquet(path)
        if days != [versions.WHOLE]:
            rows = rows.where(F.col(partition_col).cast("string").isin(days))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
