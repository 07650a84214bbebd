"""Loaders for the parquet tables and the paper-shaped views derived from them.

The feed operators work on *papers*: ``id, title, summary, authors, categories,
date, seq`` (see ``quire.schema``).  The checked tables are generic, so this
module derives paper-shaped views from them with plain column expressions
(narrow, no shuffle).  The same view is restated in DuckDB SQL by the query
registry, so both engines see identical input rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

EPOCH = "2024-01-01"      # first day of the derived paper dates
N_DAYS = 30               # derived dates cycle over 30 days
N_SOURCES = 20


# Text-heavy tables: their per-row work is CPU-bound, so a scan with fewer
# splits than cores (files with few row groups) is spread out first.
TEXT_TABLES = {"documents", "pages", "conversations"}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balance(df) if name in TEXT_TABLES else df


def balance(df: DataFrame) -> DataFrame:
    """Scan-parallelism guard: round-robin to the cluster's parallelism when
    the scan yields fewer splits than that.  On a large input the scan
    already has many splits and this is a no-op (no shuffle is added)."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def papers_view(documents: DataFrame) -> DataFrame:
    """One paper per document: first line as title, text as abstract.

    ``categories`` is an array whose first element is the primary category;
    ``authors`` an array of two names; ``date`` cycles over 30 days.
    """
    d = F.col("doc_id")
    authors_csv = F.concat(F.lit("Author "), (d % 37).cast("string"),
                           F.lit(", Author "), ((d * 5) % 41).cast("string"))
    cats_csv = F.concat(F.col("source"), F.lit(",src"), ((d * 7 + 3) % N_SOURCES).cast("string"))
    return documents.select(
        d.cast("string").alias("id"),
        # First line: substring_index stops at the first newline (split_part
        # would split the whole text into lines first).
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text").alias("summary"),
        F.col("source").alias("primary_category"),
        F.split(cats_csv, ",").alias("categories"),
        F.split(authors_csv, ", ").alias("authors"),
        F.col("lang").alias("language"),
        F.date_add(F.lit(EPOCH).cast("date"), (d % N_DAYS).cast("int")).alias("date"),
        d.alias("seq"),
    )


def event_feed(events: DataFrame) -> DataFrame:
    """Events as a daily feed: id = user:event_type, date = day of ts, seq = event_id."""
    return events.select(
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("id"),
        F.to_date(F.col("ts")).alias("date"),
        F.col("event_id").alias("seq"),
        "event_type", "value", "props",
    )


def document_feed(documents: DataFrame) -> DataFrame:
    """Documents as a daily feed keyed by content: exact copies share an id."""
    d = F.col("doc_id")
    return documents.select(
        F.md5(F.col("text")).alias("id"),
        F.date_add(F.lit(EPOCH).cast("date"), (d % N_DAYS).cast("int")).alias("date"),
        d.alias("seq"),
        "source", "lang",
    )


def enriched_view(documents: DataFrame) -> DataFrame:
    """Papers with model fields: lines 2-6 of the text stand for tl;dr,
    motivation, method, result and conclusion; a missing line is a missing
    field (such rows are incomplete for the digest)."""
    p = papers_view(documents)
    # The first seven pieces only: lines 2-6 exactly, the rest of the text in the last piece.
    p = p.withColumn("_lines", F.split(F.col("summary"), "\n", 7))
    line = lambda i: F.nullif(F.try_element_at(F.col("_lines"), F.lit(i)), F.lit(""))
    ai = F.struct(*[line(i + 2).alias(f) for i, f in
                    enumerate(["tldr", "motivation", "method", "result", "conclusion"])])
    return (p.withColumn("AI", ai).drop("_lines")
            .withColumn("abs", F.concat(F.lit(fixed.ABS_URL_PREFIX), F.col("id"))))
