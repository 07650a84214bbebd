"""Hierarchical multi-length packing of token ids.

Documents are tokenized and packed inside the scan's own tasks, so no text and
no id is shuffled.  A document's full windows are sequences by themselves; the
rest is routed to the smallest context-size tier that holds it.  Tiers are
packed from the longest: each window opens with the longest document routed to
it, its gap takes the longest documents of the same or shorter tiers that fit,
and a cut of one short document closes it exactly.  Windows of one tier are
dealt into step groups of equal tokens and near-equal attention cost.

Defined results: a null or empty text has only its end id; documents with
equal ids or equal texts are packed as separate documents; a null doc_id is
kept; other columns are ignored; an empty table gives no row.  Ids that are
left when a task's input ends close in sequences of descending powers of two,
so no sequence needs padding.  Memory: ``batch_tokens`` ids plus one document.
"""
from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import chunked

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long")
WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
END_ID = 1
BATCH_TOKENS = 2_000_000
STEP_TOKENS = 16 * 2048

Piece = tuple[int, int, int]          # document, start, length


def plan_windows(rests: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Windows (tier, pieces) filled exactly, and the pieces that did not fill one."""
    pool = sorted((length, doc, start) for doc, start, length in rests if length)
    closed: list[tuple[int, list[Piece]]] = []
    left: list[Piece] = []
    while pool:
        length, doc, start = pool.pop()
        tier = tiers[bisect.bisect_left(tiers, length)]
        pieces, gap = [(doc, start, length)], tier - length
        while gap and pool:
            i = bisect.bisect_right(pool, (gap, 1 << 62, 0)) - 1
            if i >= 0:                                   # the longest that fits
                n, d, s = pool.pop(i)
                pieces.append((d, s, n))
                gap -= n
            else:                                        # all are longer: cut the shortest
                n, d, s = pool.pop(0)
                pieces.append((d, s, gap))
                bisect.insort(pool, (n - gap, d, s + gap))
                gap = 0
        if gap:
            left += pieces
        else:
            closed.append((tier, pieces))
    return closed, left


def close_rest(pieces: list[Piece], window: int = WINDOW) -> list[tuple[int, list[Piece]]]:
    """Sequences of descending powers of two over the last pieces, in order."""
    total = sum(p[2] for p in pieces)
    sizes = [window] * (total // window) + [1 << b for b in range(window.bit_length() - 1, -1, -1) if (total % window) >> b & 1]
    out, queue = [], list(reversed(pieces))
    for size in sizes:
        took, gap = [], size
        while gap:
            doc, start, n = queue.pop()
            if n > gap:
                queue.append((doc, start + gap, n - gap))
                n = gap
            took.append((doc, start, n))
            gap -= n
        out.append((size, took))
    return out


def step_groups(sequences: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence: groups hold one tier and at most
    ``step_tokens`` tokens; sequences are dealt to and fro by attention cost."""
    out = [0] * len(sequences)
    nxt = 0
    by_tier: dict[int, list[int]] = {}
    for i, (tier, _) in enumerate(sequences):
        by_tier.setdefault(tier, []).append(i)
    for tier in sorted(by_tier):
        members = sorted(by_tier[tier], key=lambda i: -sum(p[2] ** 2 for p in sequences[i][1]))
        groups = -(-len(members) * tier // step_tokens)
        for k, i in enumerate(members):
            turn, at = divmod(k, groups)
            out[i] = nxt + (at if turn % 2 == 0 else groups - 1 - at)
        nxt += groups
    return out


class _Packer:
    def __init__(self, window: int, tiers: tuple[int, ...], task: int):
        self.window, self.tiers, self.base = window, tiers, task << 36
        self.sequences = self.groups = 0
        self.ids: dict[int, np.ndarray] = {}
        self.doc: dict[int, tuple[int | None, int]] = {}
        self.rests: list[Piece] = []
        self.full: list[tuple[int, list[Piece]]] = []
        self.n = self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        k, size = self.n, len(ids)
        self.n += 1
        self.ids[k], self.doc[k] = ids, (doc_id, size)
        whole = size - size % self.window
        self.full += [(self.window, [(k, s, self.window)]) for s in range(0, whole, self.window)]
        if whole < size:
            self.rests.append((k, whole, size - whole))
        self.held += size

    def flush(self, last: bool = False) -> pa.RecordBatch | None:
        closed, left = plan_windows(self.rests, self.tiers)
        closed = self.full + closed
        if last:
            closed += close_rest(left, self.window)
            left = []
        rows: list[tuple] = []
        group = step_groups(closed)
        for (tier, pieces), g in zip(closed, group):
            offset = 0
            for k, start, n in pieces:
                doc_id, size = self.doc[k]
                rows.append((doc_id, start, n, zlib.crc32(self.ids[k][start:start + n]), size, self.base + self.sequences, offset, tier, self.base + self.groups + g))
                offset += n
            self.sequences += 1
        self.groups += max(group, default=-1) + 1
        keep = {k for k, _, _ in left}
        self.ids = {k: v for k, v in self.ids.items() if k in keep}
        self.doc = {k: v for k, v in self.doc.items() if k in keep}
        self.rests, self.full = left, []
        self.held = sum(p[2] for p in left)
        if not rows:
            return None
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", window: int = WINDOW, tiers: tuple[int, ...] = TIERS,
         end_id: int = END_ID, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """docs (doc_id, text) -> one row per piece; see the module's docstring.

    ``tokenizer`` names a file of the installed public vocabularies, or is a
    path that every executor has; the last tier is the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import public_tokenizers

        from .word_tokens import WordTokens
        tokens = WordTokens(tokenizer if os.path.exists(tokenizer) else public_tokenizers.path(tokenizer))
        packer = _Packer(window, tiers, TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for part in chunked(batches, "text"):
            text = part.column("text").combine_chunks()
            ids, first = tokens.encode_column(text)
            for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                packer.add(doc_id, np.concatenate([ids[first[i]:first[i + 1]], end]))
                if packer.held >= batch_tokens:
                    if (out := packer.flush()) is not None:
                        yield out
        if (out := packer.flush(last=True)) is not None:
            yield out

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, SCHEMA)
