"""Queries of the training-data operators (whole tables, production parameters)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import containment, licenses, line_dedup, ngram_join, packing, passage_dedup, quality, resampling, sharding, spelling, spotsigs, token_counts, wrappers
from .common import materialize, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@_register("op1_quality")
def _quality(spark, sf_dir):
    """All documents scored; fitted on the labelled ones that are not held out."""
    features = materialize(quality.with_features(table(spark, sf_dir, "documents")))
    return quality.score(features, quality.train(features, table(spark, sf_dir, "labels")))


@_register("op2_spotsigs")
def _spotsigs(spark, sf_dir):
    """All documents and their edited texts fingerprinted."""
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


@_register("op3_licenses", licenses.oracle())
def _licenses(spark, sf_dir):
    """All documents against known licence texts, all their lines against known notices."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known(spark, licenses.TEXTS), licenses.known(spark, licenses.NOTICES))


@_register("op5_ngram_join")
def _ngram_join(spark, sf_dir):
    """Components of all documents under 5-word Jaccard 0.8."""
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))


@_register("op6_line_dedup")
def _line_dedup(spark, sf_dir):
    """All documents without the lines that are fuzzy copies of earlier ones."""
    return line_dedup.report(table(spark, sf_dir, "documents"), line_dedup.ALL_LINES)


@_register("op7_passage_dedup")
def _passage_dedup(spark, sf_dir):
    """All documents without the bytes of 100-byte passages that start earlier."""
    return passage_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@_register("op9_containment")
def _containment(spark, sf_dir):
    """All documents against all benchmark items."""
    return containment.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register("op10_wrappers")
def _wrappers(spark, sf_dir):
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@_register("op4_packing")
def _packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@_register("op8_sharding")
def _sharding(spark, sf_dir):
    """All documents over 24 equal shards by rendezvous hashing of doc_id."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@_register("op11_token_counts")
def _token_counts(spark, sf_dir):
    """Tokens of all documents, told from their prefix tables."""
    return token_counts.answers(token_counts.prefix_table(table(spark, sf_dir, "documents")))


@_register("op12_spelling")
def _spelling(spark, sf_dir):
    """Spelling variants of all documents' words."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@_register("op13_resampling")
def _resampling(spark, sf_dir):
    """All documents weighted towards the benchmark texts, a tenth of them drawn."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register("pipeline")
def _pipeline(spark, sf_dir):
    """All stages of corpus_pipeline over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
