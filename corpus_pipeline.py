"""The corpus pipeline: quality, line dedup, near copies, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All but the last return the columns of ``documents``; ``run``
writes every stage's result as Parquet into the shared checkpoint folder and
reads it back as the next stage's documents, so a lost executor costs a stage
at most and no plan grows from stage to stage.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import containment, line_dedup, ngram_join, packing, quality
from quire.llm.common import checkpoint_dir, prepare, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.3 or more);
    it is fitted on the labelled documents of the input tables."""
    prepare(spark)
    model = quality.train(quality.with_features(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines that are not fuzzy copies of earlier ones."""
    prepare(spark)
    return line_dedup.dedup_lines(docs, line_dedup.ALL_LINES)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return containment.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as packed token sequences, one row a piece."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages use trained numbers, hashes and a tokenizer that SQL lacks; the
#: tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    prepare(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
