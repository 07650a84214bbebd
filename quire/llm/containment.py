"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents long, so a MinHash of a whole document would
almost never meet an item's.  Items are partitioned by the size of their
shingle set (powers of two), and for each partition a document is cut into
overlapping windows of the partition's own scale (four times its lower bound,
every stretch of twice the bound lies whole in one window).  An item and the
window that holds it then have a Jaccard of at least 0.19 at containment 0.8,
and with ``HASHES`` single-row bands they share a MinHash with probability
above 0.9999.  Candidates are verified by exact shingle containment over the
whole document.  Documents that hold no shingle of any item share no MinHash
with one and are passed over.

Items are a stated query set: they are taken in blocks of bounded bytes, each
block goes to every task, and all documents are searched against it in one
pass without a shuffle.

Defined results: null or empty texts on either side match nothing; an item
with fewer than five words is one shingle and matches documents that are that
sequence; repeated items and repeated documents are reported each; other
columns are ignored by ``search`` and kept by ``drop_contaminated``; an empty
table on either side gives no match.
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

WORDS = 5
CONTAINMENT = 0.8
HASHES = 48
BLOCK_BYTES = 8 << 20        # of item text in one block
_SEEDS = np.random.default_rng(977).integers(1, 1 << 63, HASHES, dtype=np.uint64)
_BITMAP = 22

SCHEMA = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"


@dataclass
class Block:
    """The index of a block of items."""
    item_id: list
    sets: np.ndarray                       # sorted distinct shingles of all items, item by item
    first: np.ndarray
    all: np.ndarray                        # all of them, sorted
    known: np.ndarray                      # bitmap of their low bits
    partitions: dict[int, tuple[np.ndarray, np.ndarray]]   # size class -> (hash number x value keys, sorted; item of each)


def _shingles(data: np.ndarray, offsets: np.ndarray):
    data = bw.LOWER[data]
    _, _, first, h = bw.words(data, offsets)
    return bw.shingles(h, first, WORDS)


def _low(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64((1 << _BITMAP) - 1)).astype(np.int64)


def _keys(i, values: np.ndarray) -> np.ndarray:
    """MinHash i's values, made distinct from those of other hash numbers."""
    return bw.mix(values ^ bw.mix(np.asarray(i, np.uint64)))


def build(item_id: list, text: pa.Array) -> Block:
    v, first = bw.distinct_sorted(*_shingles(*bw.text_bytes(text)))
    known = np.zeros(1 << _BITMAP, bool)
    known[_low(v)] = True
    sizes = np.diff(first)
    parts: dict[int, tuple[list, list]] = {}
    for k in np.flatnonzero(sizes):
        own = v[first[k]:first[k + 1]]
        keys, items = parts.setdefault(int(sizes[k]).bit_length() - 1, ([], []))
        for i, seed in enumerate(_SEEDS):
            keys.append(_keys(i, bw.mix(own ^ seed).min()))
            items.append(k)
    done = {}
    for c, (keys, items) in parts.items():
        keys, items = np.array(keys, np.uint64), np.array(items)
        order = np.argsort(keys, kind="stable")
        done[c] = (keys[order], items[order])
    return Block(item_id, v, first, np.unique(v), known, done)


def candidates(block: Block, values: np.ndarray, hits: np.ndarray) -> set[int]:
    """Items that share a MinHash with a window of a document's shingles (in
    order).  ``hits`` are the places of item shingles: only windows with one of
    them can share a MinHash, so only these are hashed."""
    out: set[int] = set()
    n = len(values)
    for c, (keys, items) in block.partitions.items():
        stretch = 2 << c
        last = (n - 1) // stretch
        at = np.unique(hits // stretch)
        windows = np.unique(np.clip(np.concatenate([at - 1, at]), 0, max(last - 1, 0)))
        needed = np.unique(np.minimum(np.concatenate([windows, windows + 1]), last))
        size = np.minimum(stretch, n - needed * stretch)
        begin = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(needed * stretch - begin, size)
        low = np.minimum.reduceat(bw.mix(values[place][None, :] ^ _SEEDS[:, None]), begin, axis=1)
        low = np.minimum(low[:, np.searchsorted(needed, windows)], low[:, np.searchsorted(needed, np.minimum(windows + 1, last))])
        k = _keys(np.arange(HASHES, dtype=np.uint64)[:, None], low).ravel()
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        for x, y in set(zip(lo[hi > lo].tolist(), hi[hi > lo].tolist())):
            out.update(items[x:y].tolist())
    return out


def matches(block: Block, data: np.ndarray, offsets: np.ndarray, threshold: float) -> list[tuple[int, int, int, int]]:
    """(text, item, item's shingles, shared) for a chunk of texts."""
    v, first = _shingles(data, offsets)
    hit = np.flatnonzero(block.known[_low(v)])
    at = np.minimum(np.searchsorted(block.all, v[hit]), max(len(block.all) - 1, 0))
    hit = hit[block.all[at] == v[hit]] if len(block.all) else hit[:0]
    owner = np.searchsorted(first, hit, "right") - 1
    out = []
    for t, places in zip(*_runs(owner, hit)):
        own = v[first[t]:first[t + 1]]
        whole = None
        for k in sorted(candidates(block, own, places - first[t])):
            if whole is None:
                whole = np.unique(own)
            item = block.sets[block.first[k]:block.first[k + 1]]
            shared = int(np.isin(item, whole, assume_unique=True).sum())
            if shared >= threshold * len(item) - 1e-9:
                out.append((int(t), k, len(item), shared))
    return out


def _runs(owner: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values gathered by their (ascending) owner."""
    if not len(owner):
        return [], []
    cut = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    return owner[np.concatenate([[0], cut])].tolist(), np.split(values, cut)


def blocks(items: DataFrame, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Index blocks of (item_id, text), each made from at most about ``size`` bytes."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // size)
    for b in range(n):
        got = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").toArrow()
        if got.num_rows:
            yield build(got.column("item_id").to_pylist(), got.column("text"))


def search(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """-> one row per (document, item) whose containment reaches the threshold."""
    spark = docs.sparkSession
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    found = None
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    for block in blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            b = shared.value
            for part in chunked(batches, "text"):
                ids = part.column("doc_id").to_pylist()
                got = [(ids[t], b.item_id[k], n, s, s / n) for t, k, n, s in matches(b, *bw.text_bytes(part.column("text")), threshold)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i == 4 else pa.int64()) for i, c in enumerate(zip(*got))], names=names)
        one = rows.mapInArrow(run, SCHEMA)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item; no shuffle."""
    schema = docs.schema
    for block in blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in chunked(batches, "text"):
                bad = np.zeros(part.num_rows, bool)
                bad[[t for t, *_ in matches(shared.value, *bw.text_bytes(part.column("text")), threshold)]] = True
                yield from part.filter(pa.array(~bad)).combine_chunks().to_batches()
        docs = docs.mapInArrow(run, schema)
    return docs
