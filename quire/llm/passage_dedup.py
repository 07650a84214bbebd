"""Exact removal of repeated 100-byte passages with a run-length index.

A byte goes if a 100-byte string that covers it also starts earlier.  Sorting
every suffix of a corpus is neither bounded nor needed, so the work is split:

1. *Anchors.*  In every 100-byte window the 16-byte string of least hash (the
   leftmost of equals) is its anchor.  Equal windows have equal anchors at
   equal places, so two equal windows always meet under their anchor; about
   one byte in 43 is one.  An anchor's context is all that its windows cover
   (84 bytes before it, 84 after).
2. *Classes.*  Under one anchor, occurrences with one and the same context are
   one class: all windows of all but the first are repeats.  Inside a task a
   class is reduced to its first occurrence before anything is shuffled, so an
   anchor that a third of all documents share costs one row a task and class.
3. *Contested contexts.*  The first occurrences of different contexts under
   one anchor may share some windows.  Those that also share 42 bytes beside
   the anchor (a common window has as many on one side) are gathered, and
   their texts are indexed: suffix order, Burrows-Wheeler transform, its runs.
   Match lengths are computed at the run ends only (the irreducible ones) and
   streamed along the text, where each next one is one less; suffixes whose
   match lengths reach 100 are one window, and all but its first are repeats.
   A key with more contested text than an index holds is not gathered: the
   hashes of its windows (43 at most a claimant) become rows, and each
   window's first place is a pre-aggregated minimum.

Defined results: a null or empty text has 0 bytes; texts under 100 bytes lose
nothing; repeated rows (equal doc_id and text) are one document, each row
answered alike; rows of one doc_id with different texts are ordered by a hash
of the text; a null doc_id comes first; other columns are ignored; an empty
table gives no row.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import BROADCAST_ROWS, chunked, free_shuffles, materialize, small

LENGTH = 100                 # of a passage, in bytes
GRAM = 16                    # of an anchor
TASK_ANCHORS = 2_000_000     # that a task holds at a time
BLOCK_BYTES = 1 << 20        # of contested text that one index holds
_POS = 36                    # low bits of a packed (hash, place) pair


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Places of the anchors of all windows that lie inside one text."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64)
    h = bw.prefix(data)
    at = np.arange(n - gram + 1)
    key = (bw.span_hash(h, at, at + gram) >> np.uint64(_POS) << np.uint64(_POS)) | at.astype(np.uint64)
    w = length - gram + 1
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:len(key) - w + 1], ahead[w - 1:len(key)])
    inside = np.zeros(n + 1, np.int32)
    size = np.diff(offsets)
    some = size >= length
    np.add.at(inside, offsets[:-1][some], 1)
    np.add.at(inside, offsets[1:][some] - length + 1, -1)
    valid = np.cumsum(inside[:-1])[:len(low)] > 0
    place = (low[valid] & np.uint64((1 << _POS) - 1)).astype(np.int64)
    return np.unique(place)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling of ranks from the first five symbols
    on.  Symbols over 255 are unique separators, so ranks are distinct once a
    piece's length is passed."""
    n = len(text)
    padded = np.concatenate([np.minimum(text, 256), np.zeros(5, np.int64)])
    key = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    which = np.concatenate([np.cumsum(text > 255), np.zeros(5, np.int64)])
    border = np.zeros(n, np.int64)
    for j in range(5):                  # nothing behind a separator counts; its number does
        sym = padded[j:j + n]
        key = key * 512 + np.where(ended, 0, sym + 1)
        at = (sym == 256) & ~ended
        border[at] = which[j:j + n][at]
        ended |= at
    # Five symbols of nine bits and the separator's number (a block has far fewer than 2 ** 18).
    key = key * (1 << 18) + border
    done = 5
    while True:
        order = np.argsort(key)
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([np.zeros(1, np.int64), np.cumsum(k[1:] != k[:-1])])
        if rank[order[-1]] == n - 1 or done >= 2 * n:
            return order
        nxt = np.zeros(n, np.int64)
        nxt[:max(n - done, 0)] = rank[done:] + 1
        key = rank * (n + 1) + nxt
        done *= 2


def _symbol_hashes(symbols: np.ndarray) -> np.ndarray:
    """Prefix hash sums over symbols (bytes and separators)."""
    p, _ = bw._powers(len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(bw.mix(symbols.astype(np.int64).view(np.uint64) + np.uint64(1)) * p[:len(symbols)], out=out[1:])
    return out


def run_index(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run-length index: (samples, matches): the suffixes of the rows that
    open a run of the Burrows-Wheeler transform, and the match length of each
    with the suffix in the row before."""
    bwt = text[order - 1]                      # the first suffix is preceded by the last symbol
    heads = np.flatnonzero(np.concatenate([np.ones(1, bool), bwt[1:] != bwt[:-1]]))
    samples, before = order[heads], order[heads - 1]
    border = np.flatnonzero(text > 255)
    longest = int(np.diff(np.concatenate([[-1], border, [len(text)]])).max())
    h = _symbol_hashes(np.concatenate([text, -1 - np.arange(longest + 1)]))
    # Binary search of the match lengths over prefix hashes; the first row has none before it.
    lo, hi = np.zeros(len(heads), np.int64), np.where(heads > 0, longest + 1, 1)
    while (hi - lo).max() > 1:
        mid = (lo + hi) // 2
        same = bw.span_hash(h, samples, samples + mid) == bw.span_hash(h, before, before + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid)
    return samples, lo


def repeated_windows(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For each place of ``text`` whether the ``depth`` symbols there also
    start at an earlier place."""
    n = len(text)
    order = suffix_order(text)
    samples, matches = run_index(text, order)
    # Stream the match lengths along the text: behind a sample each is one less.
    sampled = np.zeros(n, bool)
    sampled[samples] = True
    value = np.zeros(n, np.int64)
    value[samples] = matches
    last = np.maximum.accumulate(np.where(sampled, np.arange(n), 0))
    match = value[last] - (np.arange(n) - last)
    opens = match[order] < depth
    opens[0] = True
    first = np.minimum.reduceat(order, np.flatnonzero(opens))
    out = np.zeros(n, bool)
    out[order] = first[np.cumsum(opens) - 1] < order
    return out


def _identity(docs: DataFrame) -> DataFrame:
    """(d, t, doc_id, text): d orders documents, t tells texts of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.lit(-(1 << 63))).alias("d"), F.shiftrightunsigned(F.xxhash64(text), 33).alias("t"), doc.alias("doc_id"), text.alias("text"))


def occurrences(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per anchor (kind 0): h, ctx (hash of its context), sides (32 bits of hash
    of the half window before it, 32 of the one behind), d, at (t and place).
    Kind 1: an occurrence whose class has an earlier one in the same task (only
    d and at count)."""
    names = ["kind", "h", "ctx", "sides", "d", "at"]
    reach, half = length - gram, (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def out():
            h, ctx, sides, d, at = (np.concatenate(c) for c in zip(*held))
            held.clear()
            key = bw.mix(h ^ bw.mix(ctx))
            order = np.lexsort((at, d, key))
            opens = np.ones(len(h), bool)
            opens[1:] = key[order[1:]] != key[order[:-1]]
            first = order[np.maximum.accumulate(np.where(opens, np.arange(len(h)), 0))]
            repeat = np.zeros(len(h), bool)
            # A repeated row stands at the first occurrence's own place: it is no repeat of it.
            repeat[order] = (d[order] != d[first]) | (at[order] != at[first])
            # Repeats need no meeting: they are dealt by place.
            h = np.where(repeat, bw.mix(at.view(np.uint64) ^ bw.mix(d.view(np.uint64))), h)
            own = [pa.array(np.where(repeat, np.uint64(0), x).view(np.int64)) for x in (ctx, sides)]
            return pa.RecordBatch.from_arrays([pa.array(repeat.astype(np.int8)), pa.array(h.view(np.int64)), *own, pa.array(d), pa.array(at)], names=names)
        for part in chunked(batches, "text"):
            data, offsets = bw.text_bytes(part.column("text"))
            place = anchors(data, offsets, length, gram)
            if not len(place):
                continue
            of = np.searchsorted(offsets, place, "right") - 1
            begin, end = offsets[of], offsets[of + 1]
            h = bw.prefix(data)
            lo, hi = np.maximum(begin, place - reach), np.minimum(end, place + gram + reach)
            span = lambda a, b: bw.span_hash(h, a, b)
            ctx = bw.mix(span(lo, hi) + (place - lo).astype(np.uint64))
            # A side shorter than the half window has a hash of its own: no common window needs it.
            left = np.where(place - half >= begin, span(np.maximum(place - half, begin), place), bw.mix(ctx))
            right = np.where(place + gram + half <= end, span(place + gram, np.minimum(place + gram + half, end)), bw.mix(ctx ^ np.uint64(1)))
            d = np.array(part.column("d"))[of]
            t = np.array(part.column("t"))[of]
            sides = (left >> np.uint64(32) << np.uint64(32)) | (right >> np.uint64(32))
            held.append((span(place, place + gram), ctx, sides, d, (t << 32) | (place - begin)))
            count += len(place)
            if count >= TASK_ANCHORS:
                yield out()
                count = 0
        if held:
            yield out()
    return rows.select("d", "t", "text").mapInArrow(run, "kind byte, h long, ctx long, sides long, d long, at long")


def classified(found: DataFrame) -> DataFrame:
    """Rows that matter: (d, at, first): ``first`` is null for a repeat (all
    windows of the anchor are), else (h, ctx, sides) of a contested context's
    first occurrence."""
    by_class = Window.partitionBy("h", "ctx")
    by_anchor = Window.partitionBy("h")
    rows = (found.repartition("h")
            .withColumn("first", F.min(F.struct("d", "at")).over(by_class))
            .withColumn("lo", F.min("ctx").over(by_anchor)).withColumn("hi", F.max("ctx").over(by_anchor))
            .withColumn("repeat", F.expr("kind = 1 or not (d = first.d and at = first.at)")))
    return rows.where("repeat or lo <> hi").select("d", "at", F.when(~F.col("repeat"), F.struct("h", "ctx", "sides")).alias("first"))


def contested(rows: DataFrame) -> DataFrame:
    """First occurrences that share an anchor and a half window beside it with
    another context: (key, side, d, at)."""
    sides = rows.where("first is not null").select("first.ctx", "d", "at", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.xxhash64("first.h", F.shiftrightunsigned("first.sides", 32), F.lit(0)).alias("key")),
        F.struct(F.lit(1).alias("side"), F.xxhash64("first.h", F.col("first.sides").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(1)).alias("key")))).alias("s")).select("s.key", "s.side", "ctx", "d", "at")
    w = Window.partitionBy("key")
    return sides.withColumn("_lo", F.min("ctx").over(w)).withColumn("_hi", F.max("ctx").over(w)).where("_lo <> _hi").select("key", "side", "d", "at")


def _by_document(marks: DataFrame, size: int, cols: list[str], docs: DataFrame, how: str) -> DataFrame:
    """``docs`` beside the gathered marks of each (d, t); broadcast within the bound."""
    grouped = marks.groupBy("d", "t").agg(*[F.collect_list(c).alias(c) for c in cols])
    return docs.join(F.broadcast(grouped) if size <= BROADCAST_ROWS else grouped, ["d", "t"], how)


def shared_windows(rows: DataFrame, claims: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """claims (key, side, d, at) -> (d, t, lo, hi): stretches of the claimants'
    contexts whose windows start earlier in another claimant of the key.

    A window belongs to side 0 if half of its bytes beside the anchor or more
    lie before it, else to side 1, so each side needs only its part of the
    context."""
    half = (length - gram) // 2
    claims = materialize(claims)
    free_shuffles(rows.sparkSession)
    hot = materialize(claims.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * (length + half) > BLOCK_BYTES).select("key"))
    some_hot = not hot.isEmpty()
    if some_hot:
        crowded = materialize(claims.join(small(hot), "key", "left_semi"))
        claims = materialize(claims.join(small(hot), "key", "left_anti"))
    stretches = _indexed_windows(rows, claims, length, gram)
    return stretches.unionByName(_hashed_windows(rows, crowded, length, gram)) if some_hot else stretches


def _claimed(rows: DataFrame, claims: DataFrame) -> DataFrame:
    """(d, t, text, claim): the claims of each text that has some."""
    listed = claims.select("key", "side", "d", "at", F.shiftright("at", 32).alias("t"), F.expr("cast(at & 4294967295L as int)").alias("p")).select("d", "t", F.struct("key", "side", "p").alias("claim"))
    return _by_document(listed, claims.count(), ["claim"], rows.select("d", "t", "text"), "inner")


def _stretch(side: int, p: int, length: int, gram: int) -> tuple[int, int]:
    """The part of a text that a claim at place ``p`` needs."""
    reach, half = length - gram, (length - gram) // 2
    lo, hi = (p - reach, p + gram + reach - half) if side == 0 else (p - half + 1, p + gram + reach)
    return max(0, lo), hi


def _hashed_windows(rows: DataFrame, claims: DataFrame, length: int, gram: int) -> DataFrame:
    """The same stretches as of ``_indexed_windows``, one row a repeated window:
    no key is gathered, whatever its claimants."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            data, offsets = bw.text_bytes(part.column("text"))
            h = bw.prefix(data)
            for i, (d, t, cl) in enumerate(zip(*[part.column(c).to_pylist() for c in ("d", "t", "claim")])):
                begin, n = int(offsets[i]), int(offsets[i + 1] - offsets[i])
                keys, places = [], []
                for c in cl:
                    lo, hi = _stretch(c["side"], c["p"], length, gram)
                    at = np.arange(lo, min(hi, n) - length + 1)
                    keys.append(np.full(len(at), c["key"], np.int64))
                    places.append(at)
                key, at = np.concatenate(keys), np.concatenate(places)
                if len(at):
                    window = bw.span_hash(h, begin + at, begin + at + length).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(window), pa.array(np.full(len(at), d, np.int64)), pa.array((t << 32) | at)], names=["key", "window", "d", "at"])
    found = materialize(_claimed(rows, claims).mapInArrow(run, "key long, window long, d long, at long"))
    at = F.struct("d", "at")
    first = (found.groupBy("key", "window").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
             .select("key", "window", F.col("first.d").alias("first_d"), F.col("first.at").alias("first_at")))
    return (found.join(small(materialize(first)), ["key", "window"]).where("d <> first_d or at <> first_at")
            .select("d", F.shiftright("at", 32).alias("t"), F.expr("at & 4294967295L").alias("lo")).distinct().withColumn("hi", F.col("lo") + length))


def _indexed_windows(rows: DataFrame, claims: DataFrame, length: int, gram: int) -> DataFrame:
    """Stretches of the claims' repeated windows, by a run-length index a block of keys."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            out = []
            for d, t, text, cl in zip(*[part.column(c).to_pylist() for c in ("d", "t", "text", "claim")]):
                raw = text.encode()
                for c in cl:
                    lo, hi = _stretch(c["side"], c["p"], length, gram)
                    out.append((c["key"], d, t, lo, raw[lo:hi]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 4 + [pa.binary()])], names=["key", "d", "t", "lo", "bytes"])
    pieces = _claimed(rows, claims).mapInArrow(texts, "key long, d long, t long, lo long, bytes binary")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by (key, d, t, lo): indexes whole keys, as many as a block holds."""
        block: list[tuple] = []
        size = 0

        def out():
            # Stretches of one document that touch are one, so every place is in the index once.
            merged: list[tuple] = []
            for _, d, t, lo, raw in sorted(block, key=lambda r: r[1:4]):
                if merged and merged[-1][:2] == (d, t) and lo <= merged[-1][2] + len(merged[-1][3]):
                    p = merged.pop()
                    merged.append((d, t, p[2], p[3][:lo - p[2]] + raw if lo + len(raw) > p[2] + len(p[3]) else p[3]))
                else:
                    merged.append((d, t, lo, raw))
            ends = np.cumsum([len(m[3]) + 1 for m in merged])
            text = np.zeros(ends[-1], np.int64)
            for (_, _, _, raw), e in zip(merged, ends):
                text[e - 1 - len(raw):e - 1] = np.frombuffer(raw, np.uint8)
            text[ends - 1] = 256 + np.arange(len(merged))
            hit = repeated_windows(text, length)
            got = []
            for (d, t, lo, raw), e in zip(merged, ends):
                begin = e - 1 - len(raw)
                starts = np.flatnonzero(hit[begin:max(begin, e - length)])
                if len(starts):
                    cut = np.flatnonzero(np.diff(starts) > length)
                    for x, y in zip(np.concatenate([starts[:1], starts[cut + 1]]).tolist(), np.concatenate([starts[cut], starts[-1:]]).tolist()):
                        got.append((d, t, lo + x, lo + y + length))
            block.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], names=["d", "t", "lo", "hi"]) if got else None
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if size >= BLOCK_BYTES and row[0] != block[-1][0]:
                    if (o := out()) is not None:
                        yield o
                    size = 0
                block.append(row)
                size += len(row[4])
        if block and (o := out()) is not None:
            yield o
    return (pieces.repartition("key").sortWithinPartitions("key", "d", "t", "lo").mapInArrow(match, "d long, t long, lo long, hi long"))


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    rows = _identity(docs)
    spark = docs.sparkSession
    found = materialize(classified(occurrences(rows, length, gram)))
    free_shuffles(spark)
    partial = materialize(shared_windows(rows, contested(found), length, gram))
    free_shuffles(spark)
    reach = length - gram
    whole = found.where("first is null").select("d", F.shiftright("at", 32).alias("t"), F.expr(f"cast(at & 4294967295L as int) - {reach}").alias("lo"), F.expr(f"cast(at & 4294967295L as int) + {gram + reach}").alias("hi"))
    marks = whole.unionByName(partial.select("d", "t", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))).select("d", "t", F.struct("lo", "hi").alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "text"):
            out = []
            data, offsets = bw.text_bytes(part.column("text"))
            lists = part.column("gone").combine_chunks()
            starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy())])
            flat = lists.flatten()
            lo, hi = (np.array(flat.field(i), np.int64) for i in (0, 1))
            for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                raw = data[offsets[i]:offsets[i + 1]]
                n = len(raw)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, np.maximum(lo[starts[i]:starts[i + 1]], 0), 1)
                np.add.at(edge, np.minimum(hi[starts[i]:starts[i + 1]], n), -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((doc_id, n, int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(zip(*out))], names=[x.split()[0] for x in SCHEMA.split(", ")])
    return _by_document(marks, marks.count(), ["gone"], rows, "left").select("doc_id", "text", "gone").mapInArrow(run, SCHEMA)
