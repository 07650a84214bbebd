"""SpotSigs fingerprints: chains of content words behind common-word anchors.

Every common word (and every sentence start) is an anchor; its signature is
the anchor with the next ``CHAIN`` content words.  A text's fingerprint is the
set of its signatures.  Two fingerprints are compared by Jaccard likeness;
sets are partitioned by length, as a likeness of t is only possible between
lengths within a factor t.

Defined results: a null text is an empty text; a text without a word has the
empty fingerprint (like another empty one with 1, like any other with 0); a
chain that meets the text's end is shorter; equal texts have equal
fingerprints.  Rows with equal doc_id keep their own rows and are ordered by
text; a null doc_id comes first.  A single row is its own next document.
Other columns are ignored; an empty table gives no row.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import chunked, materialize, partitions
from .components import components, linked_groups

#: Common words of the four languages that the corpus is written in.
COMMON = frozenset("""
the a an of and or to in on at is are was were be by for with that this it he as from not have has had you they which what
der die das den dem des ein eine und oder zu im in auf ist sind war von mit für nicht sich auch als an aus bei nach wie
le la les un une des du de et ou à en dans est sont que qui pour par pas sur avec il elle ce se au aux plus
el los las una uno unos y o del que es son por para con no se su al lo como más pero sus
""".split())
CHAIN = 2
BITS = 48                     # of a signature
#: Texts taken at a time, in bytes: each stands in memory as itself, edited,
#: and as two fingerprints.
CHUNK_BYTES = 256 << 10

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def _hash_words(items: list[str]) -> np.ndarray:
    data, offsets = bw.text_bytes(pa.array(items, pa.large_string()))
    return bw.words(data, offsets, ~_WORD)[3]


_ANCHORS = np.sort(_hash_words(sorted(COMMON)))


def signatures(data: np.ndarray, offsets: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): each text's sorted distinct signatures."""
    data = bw.LOWER[data]
    start, _, first, h = bw.words(data, offsets, ~_WORD)
    if not len(h):
        return h, np.zeros(len(offsets), np.int64)
    at = np.minimum(np.searchsorted(_ANCHORS, h), len(_ANCHORS) - 1)
    common = _ANCHORS[at] == h
    stops = np.concatenate([np.zeros(1, np.int64), np.cumsum(_STOP[data])])
    opens = np.zeros(len(h), bool)
    opens[1:] = stops[start[1:]] != stops[start[:-1]]
    opens[first[:-1][np.diff(first) > 0]] = True
    content = np.flatnonzero(~common)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    values, texts = [], []
    # A common word looks behind itself, a sentence start at its own word too.
    for anchors, skip, tag in ((np.flatnonzero(common), 1, None), (np.flatnonzero(opens), 0, np.uint64(0x5EED))):
        limit = first[owner[anchors] + 1]
        k = np.searchsorted(content, anchors + skip)
        v = h[anchors].copy() if tag is None else np.full(len(anchors), tag)
        with np.errstate(over="ignore"):
            for j in range(chain):
                c = np.append(content, len(h) + 1)[np.minimum(k + j, len(content))]
                inside = c < limit
                v = bw.mix(v * bw._STEP[1] + np.where(inside, np.append(h, np.zeros(1, np.uint64))[np.minimum(c, len(h))], np.uint64(j + 1)))
        values.append(v >> np.uint64(64 - BITS))
        texts.append(owner[anchors])
    v, t = np.concatenate(values), np.concatenate(texts)
    order = np.argsort(t, kind="stable")
    return bw.distinct_sorted(v[order], np.searchsorted(t[order], np.arange(len(first))))


def as_text(values: np.ndarray) -> str:
    """A fingerprint as hex digits, 12 a signature, ascending."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard of two sorted distinct arrays; 0 where their lengths alone keep
    it below ``at_least`` (the partition bound)."""
    lo, hi = sorted((len(a), len(b)))
    if not hi:
        return 1.0
    if not lo or lo < at_least * hi:
        return 0.0
    shared = int(np.isin(a, b, assume_unique=True).sum())
    return shared / (lo + hi - shared)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_spots, fingerprint); no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            v, first = signatures(*bw.text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), pa.array(np.diff(first)), pa.array([as_text(v[a:b]) for a, b in zip(first, first[1:])])], names=["doc_id", "n_spots", "fingerprint"])
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id long, n_spots long, fingerprint string")


def _prefix_entries(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, node, n, pos, rank) of each set's rare signatures.

    Two sets of likeness ``threshold`` share one of the first n - ceil(t n) + 1
    signatures of a common order; the rarest come first, so few sets meet.  The
    key is a signature in a length class, and a set stands in its own class and
    in the one below: partners lie in one class or in neighbouring ones."""
    spots = sets.select("node", "n", F.explode("spots").alias("spot"))
    often = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("often"))
    order = F.array_sort(F.collect_list(F.struct("often", "spot")))
    ordered = spots.join(often, "spot").groupBy("node", "n").agg(order.alias("o"))                  # a set's own signatures
    keep = F.expr(f"n - cast(ceil({threshold} * n - 1e-9) as int) + 1")
    near = ordered.select("node", "n", F.col("o")[0]["often"].alias("rank"), F.posexplode(F.slice("o", F.lit(1), keep)).alias("pos", "s"))
    klass = F.floor(F.log(F.col("n")) / -math.log(threshold) + 1e-9)
    return near.select(F.explode(F.array(klass, klass - 1)).alias("class"), "node", "n", "pos", "rank", "s.spot").select(
        F.xxhash64("class", "spot").alias("key"), "node", "n", "pos", "rank")


def near_groups(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_spots, component_id): documents whose
    fingerprints are alike by ``threshold`` or more, directly or through others,
    are one component, named by its smallest doc_id.

    Documents with equal fingerprints are one node; a text without signatures
    is linked with nothing.  Nodes meet by rare signature and length class;
    pairs whose lengths, or whose places of meeting, keep them below the
    threshold are pruned, the rest compared exactly, all as joins."""
    prints = fingerprints(docs)
    width = BITS // 4
    spots = F.expr(f"transform(sequence(1, length(fingerprint), {width}), i -> conv(substring(fingerprint, i, {width}), 16, 10))")
    rows = materialize(prints.select("doc_id", "n_spots", F.when(F.col("n_spots") > 0, F.xxhash64("fingerprint")).alias("node"), "fingerprint"))
    sets = materialize(rows.where("node is not null").groupBy("node").agg(F.max("n_spots").alias("n"), F.max("fingerprint").alias("fingerprint"))
                       .select("node", "n", spots.cast("array<long>").alias("spots")))
    entries = materialize(_prefix_entries(sets, threshold).distinct())

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("node").alias(x), F.col("spots").alias(f"{x}_spots")) for x in "ab")
        met = pairs.join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("a_spots", "b_spots")))
        return met.where(f"both >= {threshold} * (size(a_spots) + size(b_spots) - both) - 1e-9").select("a", "b")

    # What both can share is bounded by the lengths and by what follows the meeting signature.
    may = (f"least(l_n, r_n) >= {threshold} * greatest(l_n, r_n) - 1e-9 and "
           f"least(l_n - l_pos, r_n - r_pos) * {1 + threshold} >= {threshold} * (l_n + r_n) - 1e-9")
    first = entries.groupBy("key", "node").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("rank").alias("rank"))
    comp = components(linked_groups(materialize(first), verify, may, size="n" if threshold >= 0.8 else None))
    named = rows.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(low, "component", "left").select("doc_id", "n_spots", F.coalesce("component_id", "doc_id").alias("component_id"))


def in_order(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Deal rows into ranges of doc_id, sorted, each followed by the rows that
    open the next range (``extra``; the last range by those of the first), so
    every row meets its successor in its own task.  Range borders are real
    doc_ids from a quantile sketch of that column."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"))
    n = pieces or 4 * partitions(spark)
    cuts = ", ".join(str((k + 1) / n) for k in range(n - 1)) or "0.5"
    got = rows.agg(F.expr(f"percentile_approx(_id, array({cuts}), 10000)").alias("q"), F.min("_id").alias("low")).first()
    low = got["low"]
    borders = sorted({x for x in got["q"] or [] if x != low})
    last = len(borders)
    own = F.lit(0)
    if borders:
        found = F.array_position(F.transform(F.lit(borders), lambda b: b > F.col("_id")), True)
        own = F.when(found == 0, last).otherwise(found - 1)
    before = F.when(F.col("_id") == F.lit(low), last).when(F.col("_id").isin(borders) if borders else F.lit(False), own - 1)
    dealt = (rows.withColumn("_own", own.cast("int")).withColumn("_to", F.array_compact(F.array(F.col("_own"), before.cast("int"))))
             .select("doc_id", "text", "_id", "_own", F.posexplode("_to").alias("extra", "range")))
    return (dealt.select("doc_id", "text", "range", "extra", "_id").repartition(n, "range")
            .sortWithinPartitions("range", "extra", "_id", "text").drop("_id"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_spots long, edited_spots long")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> a fingerprint of each text, of its edited text
    (second half replaced by the next document's start) and their likenesses."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def rows_of(held: list[tuple]) -> pa.RecordBatch | None:
        """held: (doc_id, text, range, extra); rows but the last have their successor behind them."""
        here = [i for i, r in enumerate(held[:-1]) if not r[3] and held[i + 1][2] == r[2]]
        if not here:
            return None
        texts = [held[i][1] for i in here]
        after = [held[i + 1][1] for i in here]
        edited = [t[:len(t) - len(t) // 2] + a[:len(t) // 2] for t, a in zip(texts, after)]
        needed = sorted({*here, *(i + 1 for i in here)})
        at = {i: k for k, i in enumerate(needed)}
        v, first = signatures(*bw.text_bytes(pa.array([held[i][1] for i in needed] + edited, pa.large_string())))
        of = lambda k: v[first[k]:first[k + 1]]
        out = []
        for j, i in enumerate(here):
            own, nxt, ed = of(at[i]), of(at[i + 1]), of(len(needed) + j)
            out.append((held[i][0], len(texts[j]), hashlib.sha256(edited[j].encode()).hexdigest(), as_text(own), as_text(ed),
                        likeness(own, ed), likeness(own, nxt), len(own), len(ed)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[tuple] = []
        for part in chunked(batches, "text", CHUNK_BYTES):
            cols = [part.column(c).to_pylist() for c in ("doc_id", "text", "range", "extra")]
            held = carry + [(i, t or "", r, e) for i, t, r, e in zip(*cols)]
            if (out := rows_of(held)) is not None:
                yield out
            carry = held[-1:]

    return in_order(docs).mapInArrow(run, SCHEMA)
