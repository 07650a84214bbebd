"""Lookup joins: metadata fill (J2), repository facts (J3), safety verdicts
(J4) and the safety gate (F13).

The remote services of a daily feed (metadata API, repository API, safety
service) are tables here: ``metadata(id, ...)``, ``repo_stats(owner, repo,
stars, pushed_at)``, ``verdicts(text_hash, flagged)``.  All joins are
equi-joins; no join hint is given, so the planner broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans from actual shuffle sizes; otherwise both sides shuffle on the key
and AQE splits skewed keys.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.papers import code_url, repo_name, repo_owner

REQUIRED = ["authors", "title", "categories", "summary"]
FILLED = ["authors", "title", "categories", "comment", "summary"]


def _present(c: str, dtype: str) -> Column:
    """JS truthiness: null, '' and [] are all missing."""
    col = F.col(c)
    if dtype.startswith("array"):
        return col.isNotNull() & (F.size(col) > 0)
    return col.isNotNull() & (col.cast("string") != "")


def fill_metadata(papers: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """A row missing any of authors / title / categories / summary takes all
    five metadata fields from the lookup; complete rows get ``comment``
    defaulted to ''; a failed lookup (no row) keeps the row as it is.

    Only incomplete rows go through the join: complete rows (the bulk) are
    never shuffled.
    """
    types = dict(papers.dtypes)
    complete = F.lit(True)
    for c in REQUIRED:
        complete = complete & _present(c, types[c])
    if "comment" not in papers.columns:
        papers = papers.withColumn("comment", F.lit(None).cast("string"))
    flagged = papers.withColumn("_complete", complete)
    done = flagged.where("_complete").withColumn("comment", F.coalesce("comment", F.lit(""))).drop("_complete")
    todo = flagged.where(~F.col("_complete")).drop("_complete")
    names = [c for c in FILLED if c in metadata.columns]
    # One row a key (the smallest by value): a repeated lookup row never multiplies papers.
    look = (metadata.groupBy(key).agg(F.min(F.struct(*names)).alias("_m"))
            .select(key, F.lit(True).alias("_found"), *[F.col(f"_m.{c}").alias(f"_m_{c}") for c in names]))
    j = todo.join(look, key, "left")
    for c in FILLED:
        if f"_m_{c}" in look.columns:
            j = j.withColumn(c, F.when(F.col("_found"), F.col(f"_m_{c}")).otherwise(F.col(c)))
    filled = j.drop("_found", *[f"_m_{c}" for c in FILLED])
    return done.unionByName(filled.select(*done.columns))


def repo_facts(df: DataFrame, repo_stats: DataFrame, text_col: str = "summary") -> DataFrame:
    """P11 + J3: ``code_url`` from the text; stars (0 when unknown) and the
    last-push day (first 10 characters) for ``github.com`` repositories."""
    x = df.withColumn("code_url", code_url(text_col)) \
          .withColumn("_owner", repo_owner(text_col)).withColumn("_repo", repo_name(text_col))
    # One row a repository (the latest push), so facts never multiply papers.
    stats = (repo_stats.groupBy(F.col("owner").alias("_owner"), F.col("repo").alias("_repo"))
             .agg(F.max(F.struct(F.col("pushed_at").alias("p"), F.col("stars").cast("long").alias("s"))).alias("_f")))
    known = F.col("_owner").isNotNull() & F.col("_repo").isNotNull()
    # Rows without a repository (most rows) have nothing to look up: they are not shuffled.
    j = x.where(known).join(stats, ["_owner", "_repo"], "left")
    j = j.withColumn("_stars", F.col("_f.s")).withColumn("_pushed", F.col("_f.p")).drop("_f")
    rest = x.where(~known).withColumn("_stars", F.lit(None).cast("long")).withColumn("_pushed", F.lit(None).cast("string"))
    return (j.unionByName(rest).withColumn("code_stars", F.coalesce(F.col("_stars"), F.lit(0)).cast("long"))
            .withColumn("code_last_update", F.coalesce(F.substring("_pushed", 1, 10), F.lit("")))
            .select(*df.columns, "code_url", "code_stars", "code_last_update"))


def code_links(df: DataFrame, repo_stats: DataFrame | None = None, text_col: str = "summary") -> DataFrame:
    """P11 with J3 where facts are at hand: the link never needs them; without
    them stars are 0 and the last push is ''.  No join is made then."""
    if repo_stats is not None:
        return repo_facts(df, repo_stats, text_col)
    return (df.withColumn("code_url", code_url(text_col)).withColumn("code_stars", F.lit(0).cast("long"))
            .withColumn("code_last_update", F.lit("")))


def text_hash(c: Column | str) -> Column:
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


def verdict_lookup(df: DataFrame, verdicts: DataFrame, text_col: str = "summary",
                   out: str = "flagged") -> DataFrame:
    """Safety verdict per text, fail-open (no verdict = not flagged)."""
    # One verdict a text: flagged if any says so.
    v = verdicts.groupBy(F.col("text_hash").alias("_h")).agg(F.bool_or("flagged").alias("_f"))
    j = df.withColumn("_h", text_hash(text_col)).join(v, "_h", "left")
    return j.withColumn(out, F.coalesce(F.col("_f"), F.lit(False))).drop("_h", "_f")


def safety_gate(df: DataFrame, verdicts: DataFrame, key: str = "id",
                fields: tuple[str, ...] = ("summary",) + tuple(f"AI.{f}" for f in fixed.AI_FIELDS)
                ) -> tuple[DataFrame, DataFrame]:
    """F13 + Q17: drop a row when its abstract or any produced field is flagged.

    Returns ``(kept, quarantine)``; the quarantine has one row per dropped row
    with its key and the first flagged field as ``reason``.  The decision is
    made per row, from its own texts (``_row`` stands for the row's texts, so
    a null or repeated key changes nothing).  Texts are exploded to ``(row,
    field, hash)`` and semi-joined to the *flagged* verdicts only (usually a
    small, broadcastable set).
    """
    present = [f for f in fields if f.split(".")[0] in df.columns]
    rows = df.withColumn("_row", F.xxhash64(*[F.coalesce(text_hash(f), F.lit("")) for f in present]))
    texts = rows.select("_row", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("field"), F.col(f).alias("t")) for i, f in enumerate(present)
    ])).alias("x")).where(F.col("x.t").isNotNull())
    hashed = texts.select("_row", "x.pos", "x.field", text_hash("x.t").alias("text_hash"))
    bad = verdicts.where(F.col("flagged")).select("text_hash").distinct()
    flagged = (hashed.join(bad, "text_hash", "left_semi").groupBy("_row")
               .agg(F.min_by("field", "pos").alias("reason")))
    kept = rows.join(flagged.select("_row"), "_row", "left_anti").drop("_row")
    return kept, rows.select(key, "_row").join(flagged, "_row").select(key, "reason")
