"""Importance resampling towards a target text collection.

A text's features are its runs of ``min_n`` to ``max_n`` words, hashed by CRC-32
into buckets.  Words are recognised by an Aho-Corasick automaton: every
distinct word between two delimiters carries its CRC and its length, one scan
over a chunk of texts emits them in order, and the CRC of a longer run is
composed from its words' CRCs and lengths without touching the text again.
A worker's automaton holds the words that it met more than once, up to
``DICTIONARY`` words; a word that it does not hold is hashed from its bytes,
so results never depend on it.

``bucket_counts`` counts a collection (summed in tasks, then one row a
bucket), ``gains`` makes one number a bucket from both collections' counts,
``weights`` sums them over each document, and ``draw`` takes the share with the
highest perturbed weights (a draw without replacement by Gumbel noise that
depends on the seed and doc_id alone).

Defined results: null texts and texts without words have no feature and weight
0; documents under ``min_words`` words are never drawn; ties go to the smaller
doc_id, a null doc_id last (its noise is that of the seed alone), then rows in
any order; repeated rows each count and are each drawn; an empty target or
collection counts 0 everywhere; other columns are ignored; an empty table
gives no row.
"""
from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import chunked, materialize, partitions

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Words that a worker's automaton holds at most (some 400 bytes each).
DICTIONARY = 60_000
#: Distinct words outside the automaton that a worker counts at a time.
WAITING = 60_000
CHUNK_BYTES = 512 << 10

#: Byte to byte: capitals become small, what is no word byte becomes a blank.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Crc:
    """CRC-32 of joined byte strings from the parts' CRCs and lengths."""

    def __init__(self):
        one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        step = (bits >> np.uint32(8)) ^ one[bits & np.uint32(255)]   # of each single bit, behind one more zero byte
        self.steps = [self._lanes(step)]

    @staticmethod
    def _lanes(columns: np.ndarray) -> np.ndarray:
        """Four tables of 256 from a linear map's 32 columns."""
        value = np.arange(256)
        out = np.zeros((4, 256), np.uint32)
        for lane in range(4):
            for b in range(8):
                out[lane] ^= np.where(value >> b & 1, columns[lane * 8 + b], 0).astype(np.uint32)
        return out

    @staticmethod
    def _apply(lanes: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = lanes[0][crc & np.uint32(255)]
        for lane in (1, 2, 3):
            out = out ^ lanes[lane][crc >> np.uint32(8 * lane) & np.uint32(255)]
        return out

    def behind(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The CRCs' share in a string that goes on for ``length`` bytes."""
        k = 0
        while (length >> k).any():
            if k == len(self.steps):
                bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
                self.steps.append(self._lanes(self._apply(self.steps[-1], self._apply(self.steps[-1], bits))))
            crc = np.where(length >> k & 1, self._apply(self.steps[k], crc), crc)
            k += 1
        return crc

    def join(self, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.behind(left, length) ^ right


class WordScanner:
    """Words of texts as (CRC, length) payloads of an automaton that grows
    with the words it meets."""

    def __init__(self, dictionary: int = DICTIONARY):
        self.limit = dictionary
        self.words: dict[str, int] = {}
        self.waiting: dict[str, int] = {}
        self.automaton = None

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(crc, length, first): the words of all texts in order; text i owns
        words first[i] to first[i + 1]."""
        raw = data.tobytes().translate(_CLEAN)
        clean = np.frombuffer(raw, np.uint8)
        start, end = bw.spans(clean != 32, offsets)
        first = np.searchsorted(start, offsets)
        crc = np.zeros(len(start), np.uint32)
        known = np.zeros(len(start), bool)
        # Borders between texts may lack a delimiter: one blank goes before each text.
        shift = np.searchsorted(offsets, end, "left")          # blanks before a word's end
        line = " ".join(["", *(raw[a:b].decode("latin-1") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())), ""])
        if self.automaton is not None and len(start):
            hits = list(self.automaton.iter(line))
            payload = np.fromiter((p for _, p in hits), np.uint64, len(hits))
            at = np.searchsorted(end + shift, np.fromiter((e for e, _ in hits), np.int64, len(hits)))
            crc[at] = payload >> np.uint64(32)
            known[at] = True
        waiting = self.waiting
        for i in np.flatnonzero(~known).tolist():
            word = raw[start[i]:end[i]]
            crc[i] = zlib.crc32(word)
            if len(self.words) < self.limit and len(word) < 64:
                key = word.decode("latin-1")
                waiting[key] = waiting.get(key, 0) + 1
        self._learn()
        return crc, end - start, first

    def _learn(self) -> None:
        """Take repeated words into the automaton once they are many enough to
        make building it anew worth while."""
        if len(self.waiting) < min(max(1000, len(self.words)), WAITING):
            return
        for w in sorted((w for w, n in self.waiting.items() if n > 1), key=lambda w: (-self.waiting[w], w))[:self.limit - len(self.words)]:
            self.words[w] = zlib.crc32(w.encode("latin-1")) << 32 | len(w)
        self.waiting.clear()
        if self.words:
            self.automaton = ahocorasick.Automaton()
            for w, payload in self.words.items():
                self.automaton.add_word(f" {w} ", payload)
            self.automaton.make_automaton()


class Features:
    """Bucket numbers of all word runs of a chunk of texts."""

    def __init__(self, buckets: int, min_n: int, max_n: int):
        self.buckets, self.min_n, self.max_n = buckets, min_n, max_n
        self.scanner, self.crc = WordScanner(), Crc()

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, text, words): each run's bucket and text, and the texts' word counts."""
        data, offsets = bw.text_bytes(column)
        crc, length, first = self.scanner.scan(data, offsets)
        n_words = np.diff(first)
        left = np.repeat(first[1:], n_words) - np.arange(len(crc))     # words from here to the text's end
        owner = np.repeat(np.arange(len(n_words)), n_words)
        blank = np.uint32(zlib.crc32(b" "))
        out, texts, run = [], [], crc
        for n in range(1, self.max_n + 1):
            if n > 1:
                run = run[:len(crc) - n + 1]
                nxt, size = crc[n - 1:], length[n - 1:]
                run = self.crc.join(self.crc.join(run, blank, np.ones(len(run), np.int64)), nxt, size)
            if n >= self.min_n:
                keep = left[:len(run)] >= n
                out.append((run[keep] % np.uint32(self.buckets)).astype(np.int64))
                texts.append(owner[:len(run)][keep])
        return np.concatenate(out), np.concatenate(texts), n_words


@functools.cache
def _features(buckets: int, min_n: int, max_n: int) -> Features:
    """A worker's features: the words it has learnt serve all its tasks."""
    return Features(buckets, min_n, max_n)


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS, min_n: int = 1, max_n: int = 1) -> DataFrame:
    """-> (bucket, n): how many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _features(buckets, min_n, max_n)
        total = np.zeros(buckets, np.int64)
        for part in chunked(batches, "text", CHUNK_BYTES):
            total += np.bincount(features(part.column("text"))[0], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["bucket", "n"])

    rows = texts.select(F.col(column).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """One number a bucket from two (bucket, n) tables of at most ``buckets``
    rows: a thousand times the smoothed log ratio of its shares, floored."""
    def dense(counts: DataFrame) -> list[int]:
        out = [0] * buckets
        for r in counts.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = dense(source), dense(target)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((y + 1) * all_s / ((x + 1) * all_t))) for x, y in zip(s, t)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, min_n: int = 1, max_n: int = 1) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_features, n_words, weight; map-only."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _features(buckets, min_n, max_n)
        for part in chunked(batches, "text", CHUNK_BYTES):
            bucket, text, words = features(part.column("text"))
            n = part.num_rows
            weight = np.zeros(n, np.int64)
            np.add.at(weight, text, gain[bucket])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), pa.array(np.bincount(text, minlength=n)), pa.array(words), pa.array(weight)],
                                             names=["doc_id", "n_features", "n_words", "weight"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def draw(weighted: DataFrame, seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, n_words, weight) -> doc_id, n_features, weight,
    score, rank (from 1; null where not drawn).  Only these narrow rows are
    sorted: dealt into ranges of the score, each row's rank is its place in its
    range behind the rows of the ranges before."""
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = materialize(weighted.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    placed = materialize(able.repartitionByRange(partitions(able.sparkSession), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    # A row's number is its range's number and its place in it (33 bits).
    placed = placed.withColumn("range", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1))
    sizes = {r["range"]: r["count"] for r in placed.groupBy("range").count().collect()}      # one row a partition
    before, done = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(done)
        done += sizes.get(k, 0)
    drawn = percent * done // 100
    starts = F.lit(before) if before else F.array(F.lit(0))
    rank = F.element_at(starts.cast("array<long>"), F.col("range").cast("int") + 1) + F.col("place") + 1
    names = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*names, F.when(rank <= drawn, rank).cast("long").alias("rank"))
    return ranked.unionByName(scored.where(F.coalesce(F.col("n_words") < min_words, F.lit(True))).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, min_n: int = 1, max_n: int = 1, seed: int = SEED,
             percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """All documents with weight, score and (where drawn) rank."""
    gain = gains(bucket_counts(docs, "text", buckets, min_n, max_n), bucket_counts(target, "text", buckets, min_n, max_n), buckets)
    return draw(weights(docs, gain, min_n, max_n), seed, percent, min_words)
