"""Spelling variants: words one edit apart, found in a frequency-vector trie.

A word's vector holds how many of its letters lie in each of a fixed row of
letter groups.  One replaced letter moves at most one count up (a surplus) and
one down (a deficit), one deleted letter moves one down, so words near each
other have vectors within a budget of one surplus and one deficit.  Words are
arranged in a trie by their successive counts; a depth-first search follows a
word's own counts and spends the budget on the way, and the words of the leaves
that it reaches are verified letter by letter.  Each pair is found once: from
the longer word, or from the one whose vector gains in the earlier group, or
(equal vectors) from the smaller word.

The trie is shared out by its top levels: the first ``TOP`` counts are the key
of a subtree, and a word is routed, with the budget it has left, to the
subtrees that its budget can reach there.  A subtree of more than ``BLOCK``
words is dealt into blocks by a hash of the word, and what is routed to it goes
to each block; a task holds one block and streams the words routed to it.

Defined results: null texts have no word; with a null doc_id the run's check
number is that of ``:<run>``; repeated rows count each; words of any length are
taken whole; a word without a near one has n_near 0 and is its own root; ties
for the form go to the smaller word in code-point order; other columns are
ignored; an empty table gives no row.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, materialize, partitions, small

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SLIP = 199                    # a run whose check number is divisible by it loses a letter
#: Letter groups, in the order of the trie's levels; other letters are in the last.
GROUPS = ("eèéêë", "nñ", "iìíîï", "rs", "t", "aàáâãäå", "dl", "oòóôõöuùúûü", "hcçg", "mbk", "pfvw")
DEPTH = len(GROUPS) + 1
TOP = 6                       # levels above the subtrees
BLOCK = 20_000                # words of a subtree in one task
HELD = 150_000                # distinct words that a task counts before it hands them on
CHUNK_BYTES = 512 << 10

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GROUP = {c: i for i, g in enumerate(GROUPS) for c in g}
_PACK = struct.Struct(f"<{DEPTH}i")
_KEY = 4 * TOP
#: What a search has spent: nothing; a surplus, so that it owes a deficit; a
#: letter less; a surplus and a deficit.
FRESH, OWING, SHORTER, REPLACED = 0, 1, 2, 3
_SCHEMA = "key binary, salt int, kind int, word string, n long, vector binary"
_NEAR = "word string, near string, near_n long"


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, slip: int = SLIP) -> DataFrame:
    """docs (doc_id, text) -> (word, n): how often each word of at least
    ``min_length`` letters occurs; counted in tasks first."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for part in chunked(batches, "text", CHUNK_BYTES):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(text.encode().translate(_LOWER).decode())).items():
                    check = zlib.crc32(word.encode(), head)
                    if check % slip == 0:
                        at = check % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) >= HELD:
                    yield out()
        if total:
            yield out()

    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vector(word: str) -> list[int]:
    """Letters of each group; runs of one letter cost no more than others."""
    out = [0] * DEPTH
    for c in word:
        out[_GROUP.get(c, DEPTH - 1)] += 1
    return out


def routes(counts: list[int], top: int = TOP) -> list[tuple[int, list[int]]]:
    """(what is spent, first counts) of the subtrees that a word's budget reaches."""
    head = counts[:top]
    out = [(FRESH, head)]
    for i in range(top):
        if head[i]:
            out.append((SHORTER, [*head[:i], head[i] - 1, *head[i + 1:]]))
        more = [*head[:i], head[i] + 1, *head[i + 1:]]
        out.append((OWING, more))
        out += [(REPLACED, [*more[:j], more[j] - 1, *more[j + 1:]]) for j in range(i + 1, top) if more[j]]
    return out


def one_edit(a: str, b: str) -> bool:
    """Is ``b`` the word ``a`` with one letter replaced, or one left out?"""
    half = len(b) // 2
    gap = len(a) - len(b)
    if a[:half] != b[:half]:
        if a[half + gap:] != b[half:]:
            return False
        half = 0
    while half < len(b) and a[half] == b[half]:
        half += 1
    return a[half + 1:] == b[half + 1 - gap:] and (gap == 1 or half < len(b))


class Subtree:
    """The trie of one block of words below their key's levels."""

    def __init__(self):
        self.root: dict = {}

    def add(self, counts: tuple[int, ...], word: str, n: int) -> None:
        node = self.root
        for c in counts[TOP:-1]:
            node = node.setdefault(c, {})
        node.setdefault(counts[-1], []).append((word, n))

    def near(self, counts: tuple[int, ...], word: str, spent: int) -> list[tuple[str, int]]:
        """Words one edit from ``word`` that a search reaches with what is left of its budget."""
        leaves: list[tuple[int, list]] = []

        def search(node, level: int, spent: int) -> None:
            if level == DEPTH:
                if spent != OWING:
                    leaves.append((spent, node))
                return
            c = counts[level]
            child = node.get(c)
            if child is not None:
                search(child, level + 1, spent)
            if spent == FRESH:
                child = node.get(c - 1)
                if child is not None:
                    search(child, level + 1, SHORTER)
                child = node.get(c + 1)
                if child is not None:
                    search(child, level + 1, OWING)
            elif spent == OWING:
                child = node.get(c - 1)
                if child is not None:
                    search(child, level + 1, REPLACED)

        search(self.root, TOP, spent)
        return [(w, n) for spent, leaf in leaves for w, n in leaf if (spent != FRESH or word < w) and one_edit(word, w)]


def _routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words -> their own row (kind -1) and one row a subtree within reach."""
    for batch in batches:
        rows: list[tuple] = []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = vector(word)
            packed = _PACK.pack(*counts)
            rows.append((packed[:_KEY], -1, word, n, packed))
            rows += [(struct.pack(f"<{TOP}i", *head), spent, word, n, packed) for spent, head in routes(counts)]
        kinds = [pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds],
                                         names=["key", "kind", "word", "n", "vector"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by (key, salt, kind): a block's words, then the words routed to it."""
    at, tree = None, Subtree()
    for batch in batches:
        out: list[tuple[str, str, int]] = []
        for key, salt, kind, word, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (key, salt):
                at, tree = (key, salt), Subtree()
            counts = _PACK.unpack(packed)
            if kind < 0:
                tree.add(counts, word, n)
                continue
            for other, m in tree.near(counts, word, kind):
                out.append((word, other, m))
                out.append((other, word, n))
        if out:
            kinds = [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["word", "near", "near_n"])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Distinct (word, n) -> (word, near, near_n), both ways round."""
    spread = words.select("word", "n").mapInArrow(_routed, "key binary, kind int, word string, n long, vector binary")
    own = spread.where("kind = -1")
    blocks = materialize(own.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    # Only subtrees that exist are searched; a word's own row goes to one block, a routed one to each.
    rows = spread.join(small(blocks), "key")
    dealt = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    salts = F.when(F.col("kind") == -1, F.array(dealt)).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("key", F.explode(salts).alias("salt"), "kind", "word", "n", "vector")
    dealt_rows = rows.repartition(partitions(words.sparkSession), "key", "salt").sortWithinPartitions("key", "salt", "kind")
    return dealt_rows.mapInArrow(_searched, _NEAR)


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, in doubling
    steps; no chain is longer than ``longest``."""
    up = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < longest:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        up = materialize(up.join(nxt, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
        reach *= 2
    return up


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, slip: int = SLIP, block: int = BLOCK) -> DataFrame:
    """docs -> one row a word: word, form, root, n, n_near, form_n."""
    words = materialize(count_words(docs, min_length, slip).where(F.col("n") >= min_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(words, block).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                   F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    # Each form is at least ``ratio`` times as frequent as its word, which bounds the chains.
    most = words.agg(F.max("n")).first()[0] or 0
    longest = 0
    while min_count * ratio ** (longest + 1) <= most:
        longest += 1
    up = roots(rows.where("form is not null"), longest)
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
