"""Exact n-gram Jaccard join as a blocked sparse matrix product.

The documents x n-grams incidence matrix is multiplied with its transpose in
two blocks of columns.  Every document's n-grams are ordered alike, rare ones
first.  The first block holds each document's prefix, the columns in which two
documents of the wanted Jaccard must meet; its non-zero products are the
candidate pairs, and pairs are dropped at once where the sizes, or the n-grams
left behind the meeting column, cannot give the needed overlap.  For the rest
the second block adds up the overlap over all columns, exactly.

Rarity comes from a counting sketch of fixed size over all documents.  It only
sets the order of columns, so its collisions cost time, never a result.

Equal sets are one node from the start (map-side), so copies are not expanded;
columns shared by one and the same family of nodes become one column; inside a
column, members are compared with pivots across components only (see
``components.linked_groups``).  No link between different sets is lost.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a
text of fewer words than n has its whole word sequence as one n-gram; a null,
empty or blank text has none and is linked with nothing; repeated rows are
copies; a document with a null doc_id takes part without an id of its own (its
component_id is that of its copies or partners, or null); other columns are
ignored; an empty table gives no row.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import chunked, free_shuffles, materialize, partitions, small
from .components import components, linked_groups

WORDS = 5
NUM, DEN = 80, 100            # the threshold as a fraction
CELL_BITS = 21                # of the counting sketch
_BLOCK_BITS = 15


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sorted distinct k-word n-gram hashes."""
    data = bw.LOWER[data]
    _, _, first, h = bw.words(data, offsets)
    return bw.distinct_sorted(*bw.shingles(h, first, k))


def _signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash a set (order-free), 0 for the empty set."""
    with np.errstate(over="ignore"):
        total = bw.per_text_sum(bw.mix(values ^ np.uint64(0x2545F4914F6CDD1D)), first)
        n = np.diff(first).astype(np.uint64)
        return np.where(n > 0, bw.mix(total + n * bw._STEP[3]), np.uint64(0))


def _cells(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")


def scan_sets(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """One pass: (doc_id, n, sig) of every document, and per task the non-zero
    cells of its n-gram counts (rows with a ``block``)."""
    names = ["doc_id", "n", "sig", "block", "cells", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.uint32)
        for part in chunked(batches, "text"):
            v, first = shingle_sets(*bw.text_bytes(part.column("text")), k)
            np.add.at(total, _cells(v), np.uint32(1)) if len(v) < 1000 else np.add(total, np.bincount(_cells(v), minlength=1 << CELL_BITS).astype(np.uint32), out=total)
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), pa.array(np.diff(first)), pa.array(_signatures(v, first).view(np.int64)),
                                              *[pa.nulls(rows, t) for t in kinds[3:]]], names=names)
        size = 1 << _BLOCK_BITS
        for b in range(1 << (CELL_BITS - _BLOCK_BITS)):
            at = np.flatnonzero(total[b * size:(b + 1) * size])
            if len(at):
                count = np.minimum(total[b * size + at], 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in kinds[:3]], pa.array([b], kinds[3]), pa.array([at.astype(np.uint16).tobytes()], kinds[4]), pa.array([count.tobytes()], kinds[5])], names=names)
    return _texts(docs).mapInArrow(run, "doc_id long, n long, sig long, block int, cells binary, counts binary")


def rarity(scanned: DataFrame) -> np.ndarray:
    """The sketch's levels, one byte a cell (2 ** CELL_BITS bytes in all): the
    binary logarithm of a cell's count over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, at, count in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                total = sums.setdefault(b, np.zeros(1 << _BLOCK_BITS, np.int64))
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(count, np.uint16)
        for b, total in sums.items():
            level = np.log2(np.maximum(total, 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["block", "level"])
    rows = scanned.where("block is not null").select("block", "cells", "counts").repartition(1 << (CELL_BITS - _BLOCK_BITS), "block")
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for r in rows.mapInArrow(run, "block int, level binary").collect():
        out[r["block"] << _BLOCK_BITS:(r["block"] + 1) << _BLOCK_BITS] = np.frombuffer(r["level"], np.uint8)
    return out


def prefixes(docs: DataFrame, level: np.ndarray, num: int, den: int, k: int) -> DataFrame:
    """(key, node, n, pos, rank): the n-grams of each distinct set's prefix, rare
    ones first; a set that a task meets again is not emitted again.  ``rank``
    is lowest for sets of the most common n-grams, the centres of families."""
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rank = shared.value
        for part in chunked(batches, "text"):
            v, first = shingle_sets(*bw.text_bytes(part.column("text")), k)
            sig = _signatures(v, first).view(np.int64)
            n = np.diff(first)
            fresh = np.zeros(len(n), bool)
            for i, s in enumerate(sig.tolist()):
                if n[i] and s not in seen:
                    seen.add(s)
                    fresh[i] = True
            owner = np.repeat(np.arange(len(n)), n)
            level = rank[_cells(v)]
            centre = (-1000 * bw.per_text_sum(level.astype(np.int64), first) // np.maximum(n, 1))
            order = np.lexsort((v, level, owner))
            pos = np.arange(len(v)) - np.repeat(first[:-1], n)
            length = n - -(-n * num // den) + 1
            keep = (pos < length[owner]) & fresh[owner]
            o = owner[keep]
            yield pa.RecordBatch.from_arrays([pa.array(v[order][keep].view(np.int64)), pa.array(sig[o]), pa.array(n[o]), pa.array(pos[keep]), pa.array(centre[o])], names=["key", "node", "n", "pos", "rank"])
    return _texts(docs).mapInArrow(run, "key long, node long, n long, pos long, rank long")


def shared_columns(prefix: DataFrame) -> DataFrame:
    """Columns that two nodes or more meet in, as (key, node, rank, n, pos, w);
    columns of one and the same family of nodes are one, at the nodes' first
    position and with their number (at least) as its weight."""
    w = Window.partitionBy("key")
    met = (prefix.withColumn("_lo", F.min("node").over(w)).withColumn("_hi", F.max("node").over(w))
           .withColumn("_sum", F.sum(F.shiftrightunsigned(F.xxhash64("node"), 34)).over(w)).where("_lo <> _hi"))
    return (met.groupBy(F.xxhash64("_lo", "_hi", "_sum").alias("key"), "node").agg(F.min("rank").alias("rank"), F.min("n").alias("n"), F.min("pos").alias("pos"), F.count(F.lit(1)).alias("w")))


def may_link(num: int, den: int) -> str:
    """Lossless bound on two entries of one column: the sizes, and the most
    overlap that is left from the (first) meeting column on."""
    return (f"least(l_n, r_n) * {den} >= {num} * greatest(l_n, r_n) and "
            f"least(l_n - l_pos, r_n - r_pos) * {num + den} >= {num} * (l_n + r_n)")


def enough_overlap(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs whose overlap, as accumulated over the first block,
    can still reach the threshold.

    ``rows`` (node, n, cols) holds each node's columns with their weights.  Of
    two nodes, the one whose prefix ends first in the common order has all of
    its shared prefix columns in the other's prefix, so the overlap is at most
    what both prefixes share plus the longer of the two suffixes."""
    suffix = lambda n: f"(ceil({n} * {num} / {den}) - 1)"
    a, b = (rows.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("cols").alias(f"{s}_cols")) for s in "ab")
    shared = (f"aggregate(filter(a_cols, x -> array_contains(transform(b_cols, y -> y.key), x.key)), 0L, (s, x) -> s + x.w)")
    return (pairs.join(a, "a").join(b, "b")
            .where(f"{num + den} * ({shared} + greatest({suffix('a_n')}, {suffix('b_n')})) >= {num} * (a_n + b_n)").select("a", "b"))


def verifier(docs: DataFrame, named: DataFrame, rows: DataFrame, num: int, den: int, k: int):
    """The second block: exact overlap of candidate pairs, over all columns.

    ``named`` (node, doc_id, materialised) tells a document of each node.  The
    texts of a pair's documents meet in one task and are cut into n-grams
    there: a text takes half the room of its hashes, and each is moved once."""
    named, rows = small(named), small(rows, weight=F.size("cols") + 1)

    def texts_of(keys: DataFrame) -> DataFrame:
        return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").join(small(keys), "doc_id").drop("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: tuple = (None, None, None)
        for part in chunked(batches, ["y"]):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            v, first = shingle_sets(*bw.text_bytes(part.column("y")), k)
            sig = _signatures(v, first).view(np.int64)
            ok = np.zeros(part.num_rows, bool)
            x = part.column("x")
            for i in range(part.num_rows):
                if hub[0] != a[i]:
                    hv, hf = shingle_sets(*bw.text_bytes(x.slice(i, 1)), k)
                    hub = (a[i], hv, _signatures(hv, hf).view(np.int64)[0])
                t = v[first[i]:first[i + 1]]
                both = int(np.isin(t, hub[1], assume_unique=True).sum())
                # Rows that repeat a doc_id may bring another text: its signature tells.
                ok[i] = sig[i] == b[i] and hub[2] == a[i] and den * both >= num * (len(t) + len(hub[1]) - both)
                if hub[2] != a[i]:
                    hub = (None, None, None)
            yield pa.RecordBatch.from_arrays([part.column("a").combine_chunks(), part.column("b").combine_chunks()], names=["a", "b"]).filter(pa.array(ok))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = enough_overlap(pairs, rows, num, den)
        ids = materialize(pairs.join(named.withColumnsRenamed({"node": "a", "doc_id": "a_doc"}), "a").join(named.withColumnsRenamed({"node": "b", "doc_id": "b_doc"}), "b"))
        hubs = texts_of(ids.select(F.col("a_doc").alias("doc_id"), "a").distinct()).withColumnRenamed("text", "x")
        others = texts_of(ids.select(F.col("b_doc").alias("doc_id"), "a", "b")).withColumnRenamed("text", "y")
        return others.join(hubs, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
    return verify


def jaccard_groups(docs: DataFrame, num: int = NUM, den: int = DEN, k: int = WORDS) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_shingles, component_id)."""
    spark = docs.sparkSession
    scanned = materialize(scan_sets(docs, k))
    level = rarity(scanned)
    sigs = scanned.where("block is null").select("doc_id", "n", "sig")
    columns = materialize(shared_columns(prefixes(docs, level, num, den, k)))
    free_shuffles(spark)
    reps = sigs.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    wanted = materialize(columns.select(F.col("node").alias("sig")).distinct().join(reps, "sig").select("doc_id", F.col("sig").alias("node")))
    rows = materialize(columns.groupBy("node").agg(F.min("n").alias("n"), F.collect_list(F.struct("key", "w")).alias("cols")))   # at most a prefix
    links = linked_groups(columns.drop("w"), verifier(docs, wanted, rows, num, den, k), may_link(num, den), size="n" if 5 * num >= 4 * den else None)
    comp = components(links).select(F.col("node").alias("sig"), "component")
    named = reps.join(comp, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    low = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = materialize(named.join(low, "component").select("sig", "component_id"))
    return (sigs.join(label, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, num: int = NUM, den: int = DEN, k: int = WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) without those whose component has a
    row of smaller doc_id (nulls last), then text hash; of repeated rows (equal
    doc_id and text) of a component's kept document one stays.  Rows without
    an n-gram all stay."""
    from .common import drop_rows
    # Rows are told apart by doc_id and text, so a doc_id may be null or have several texts.
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = docs.withColumn("__keep_row", row)
    found = materialize(jaccard_groups(named.select(F.col("__keep_row").alias("doc_id"), "text"), num, den, k).where("n_shingles > 0")
                        .groupBy(F.col("doc_id").alias("__keep_row")).agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("copies")))
    many = materialize(found.groupBy("component").agg(F.sum("copies").alias("rows")).where("rows > 1").select("component"))
    members = materialize(found.join(small(many), "component"))
    ids = named.select("__keep_row", F.col("doc_id").cast("long").alias("doc_id")).join(small(members), "__keep_row")
    kept = materialize(ids.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__keep_row")).alias("first")))
    judged = members.join(small(kept), "component").withColumn("keep", F.expr("__keep_row = first.__keep_row"))
    gone = materialize(judged.where("not keep").select("__keep_row"))
    doubled = materialize(judged.where("keep and copies > 1").select("__keep_row"))
    rest = drop_rows(named, gone, "__keep_row")
    if not doubled.isEmpty():
        once = rest.join(small(doubled), "__keep_row", "left_semi").select(*named.columns).dropDuplicates(["__keep_row"])
        rest = drop_rows(rest, doubled, "__keep_row").unionByName(once)
    return rest.drop("__keep_row")
