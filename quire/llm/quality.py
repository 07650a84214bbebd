"""Quality scores by a regularised quadratic discriminant.

Each whole text becomes a short vector of transformed statistics (logs and
log-odds of lengths, character classes, repetition).  Per class, the mean and
covariance come from one distributed aggregation of counts, sums and products;
the covariance is shrunk towards the pooled one and that towards its diagonal.
A score is the logistic of the difference of two Gaussian log-densities,
computed from Mahalanobis distances with the classes' Cholesky factors, which
are made once and shipped with the scoring function (d x d numbers a class).

Defined results: a null text is an empty text; both are scored like any other;
a label that is null, or no label row, does not take part in fitting; repeated
label rows of one document count once if they agree and not at all if they
differ; with no labelled row of a class its mean and covariance are the pooled
ones; with no labels at all every score is the prior 0.5; an empty table gives
no row.  Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import chunked

FEATURES = ("log_words", "log_word_len", "letters", "upper", "digits", "signs", "odd_signs", "sign_runs",
            "distinct_words", "distinct_shingles", "log_line_len", "repeated_lines", "short_words", "ended_lines")
ALPHA = 0.15      # weight of the pooled covariance in a class's
BETA = 0.05       # weight of the diagonal in the pooled one
RIDGE = 1e-3      # added to the diagonal
THRESHOLD = 0.3

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = ~(_LETTER | _DIGIT | bw.SPACE)
_ODD = _SIGN.copy()
_ODD[[ord(c) for c in ".,;:'\"!?()-"]] = False
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\"')"]] = True


def _odds(part: np.ndarray, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
    """Log-odds of a share, drawn to its ``usual`` value by ``weight`` imagined
    items, so that a very short text is not taken for an extreme one."""
    return np.log((part + weight * usual) / (whole - part + weight * (1 - usual)))


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(bw.distinct_sorted(values, first)[1])


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a chunk."""
    size = np.diff(offsets)
    count = lambda mask: bw.per_text_sum(mask[data], offsets)
    space, upper, letter, digit, sign, odd = (count(m) for m in (bw.SPACE, _UPPER, _LETTER, _DIGIT, _SIGN, _ODD))
    signs = _SIGN[data]
    pair = np.zeros(len(data), bool)
    pair[1:] = signs[1:] & signs[:-1]
    pair[offsets[:-1][offsets[:-1] < len(data)]] = False
    runs = bw.per_text_sum(pair, offsets)
    start, end, first, words = bw.words(data, offsets)
    n = np.diff(first)
    short = bw.per_text_sum((end - start) <= 3, first)
    shingle, s_first = bw.shingles(words, first)
    lstart, lend, lfirst, lines = bw.words(data, offsets, _NEWLINE)
    m = np.diff(lfirst)
    ended = bw.per_text_sum(_STOP[data[np.maximum(lend - 1, 0)]] if len(lend) else np.zeros(0, bool), lfirst)
    distinct_lines = _distinct(lines, lfirst)
    return np.column_stack([
        np.log1p(n), np.log((size - space + 50) / (n + 10)), _odds(letter, size - space, 0.96, 50), _odds(upper, letter, 0.03, 50),
        _odds(digit, size - space, 0.01, 50), _odds(sign, size - space, 0.03, 50), _odds(odd, size - space, 0.005, 50),
        _odds(runs, np.maximum(sign, runs), 0.02, 20), _odds(_distinct(words, first), n, 0.8, 10),
        _odds(_distinct(shingle, s_first), np.diff(s_first), 0.98, 10), np.log1p((size + 200) / (m + 1)),
        _odds(m - distinct_lines, m, 0.02, 5), _odds(short, n, 0.3, 10), _odds(ended, m, 0.9, 3),
    ]).astype(np.float64)


def with_features(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, features array)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            x = features(*bw.text_bytes(part.column("text")))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), flat], names=["doc_id", "x"])
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id long, x array<double>")


def held_out():
    return (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5) == 0


@dataclass
class Model:
    """Means, Cholesky factors and half log-determinants of classes 0 and 1."""
    mean: np.ndarray
    factor: np.ndarray
    half_logdet: np.ndarray
    log_prior: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        density = []
        for c in (0, 1):
            z = np.linalg.solve(self.factor[c], (x - self.mean[c]).T)
            density.append(self.log_prior[c] - self.half_logdet[c] - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(labelled: DataFrame, alpha: float = ALPHA, beta: float = BETA, ridge: float = RIDGE) -> Model:
    """labelled (x, label 0/1) -> Model; one aggregation, one row a task and class."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for b in batches:
            x = np.array(b.column(0).flatten()).reshape(-1, d)
            y = np.array(b.column(1))
            for c in total:
                z = x[y == c]
                total[c] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["c", "m"])

    rows = (labelled.select("x", F.col("label").cast("int").alias("label")).where("label in (0, 1)").mapInArrow(moments, "c int, m array<double>")
            .select("c", F.posexplode("m").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("v")).collect())
    m = np.zeros((2, 1 + d + d * d))
    for r in rows:
        m[r["c"], r["i"]] = r["v"]
    n = m[:, 0]
    everything = m.sum(axis=0)
    if everything[0] == 0:
        return Model(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), np.log([0.5, 0.5]))
    overall = everything[1:1 + d] / everything[0]
    mean = np.stack([m[c, 1:1 + d] / n[c] if n[c] else overall for c in (0, 1)])
    scatter = [m[c, 1 + d:].reshape(d, d) - n[c] * np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / max(everything[0], 1)
    pooled = (1 - beta) * pooled + beta * np.diag(np.diag(pooled)) + ridge * np.eye(d)
    factor = []
    for c in (0, 1):
        # Few rows lean on the pooled covariance, many on the class's own.
        a = max(alpha, min(1.0, d / (n[c] + 1e-9)))
        factor.append(np.linalg.cholesky((1 - a) * scatter[c] / max(n[c], 1) + a * pooled + ridge * np.eye(d)))
    prior = (n + 1) / (n.sum() + 2)
    return Model(mean, np.stack(factor), np.array([np.log(np.diag(f)).sum() for f in factor]), np.log(prior))


def train(features: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents that are not held out.  ``features``
    (doc_id, x) are a few numbers a document: they meet the labels, not texts."""
    y = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_hi"))
         .where("label = _hi").where(~held_out()).select("doc_id", "label"))
    return fit(features.join(y, "doc_id"))


def score(features: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """features (doc_id, x) -> (doc_id, held_out, score, predicted); no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])
    scored = features.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores at least the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            s = model.score(features(*bw.text_bytes(part.column("text"))))
            yield from part.filter(pa.array(s >= threshold)).combine_chunks().to_batches()
    return docs.mapInArrow(run, schema)
