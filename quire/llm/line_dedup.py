"""Fuzzy line dedup by SimHash blocks.

Every line is normalised to its words (lower case, split at ASCII signs and
blanks).  Its SimHash is made in blocks: each content word (common words of the
corpus's languages vote only where a line has no other) votes in the one block
that its own hash names, some four words to a block, so a changed word touches
the block that it leaves and the one that it enters and no other.  Two lines
whose changes touch fewer than all blocks have an equal one (pigeonhole), and
all lines that share a block are candidates.  As blocks meet only when they are
equal, a block's votes are taken as one hash of the words that vote in it.
Blocks are a power of two by the line's content words; a line near the border of
two powers has both, so lines of slightly different length still meet.

A line's SimHash as a whole (64 bits, the majority of its content words' hash
bits) passes over candidates that have only a block in common: beyond
``DISTANCE`` bits they are not compared, short lines apart.  Lines of at most
``GRAM_LENGTH`` characters have a bitmap of their character pairs too: an edit
changes four of its bits at most, so pairs further apart than their edits allow
cannot link and are no candidates.  Candidates whose edit similarity (1 - Levenshtein / longer length, on normalised
lines) reaches the threshold link; of each connected group of lines the first
occurrence by (doc_id, line) stays and the others go.  Most linked lines differ
in a few words: the edits of an alignment word by word are counted first (no
fewer than the distance), and only pairs that it leaves open take the distance.

Words are found and hashed in one pass over whole arrays of bytes, each line
leaving it as its place, its hash and its blocks' hashes; everything after that
is joins.  Equal lines are one node, so copies are never paired; a block's
members are compared with its pivot first, then across groups only.  Lines of at
most ``GRAM_LENGTH`` characters bring their texts, so their pairs are decided
where they meet; texts of longer lines are fetched for candidates alone.

Not found are linked lines whose changes touch every block or more bits: the
tests measure the share against all pairs of lines.

Defined results: a null text has one empty line and becomes an empty text;
lines of fewer than ``min_words`` words are never removed and never keep
another line from staying (the query and the pipeline take ``ALL_LINES``: only
lines without a word stay as they are); repeated rows
(equal doc_id and text) are one document, each row losing the same lines; a
null doc_id comes first in the order; lines of any length are treated alike;
other columns pass through ``dedup_lines`` unchanged but for ``n_chars``, which
follows the text; an empty table gives no row.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import BROADCAST_ROWS, chunked, compact, free_shuffles, materialize, small
from .components import components
from .spotsigs import COMMON

MIN_WORDS = 5
ALL_LINES = 1                # as min_words: every line that has a word
SIMILARITY = 0.8
#: Content words a block (about), and the blocks of lines with fewer than
#: ``SHORT`` content words and of others at least (as powers of two).
BLOCK_WORDS = 4
SHORT, SHORT_BITS, LEAST_BITS = 12, 2, 3
#: A block of fewer votes is no candidate's reason, but in short lines any is.
VOTES = 2
#: Lines this near (by ratio of content words) to the border of two powers have both.
BORDER = 1.06
#: Bits in which the SimHashes of compared lines differ at most, where the
#: shorter line has this many characters or more.
DISTANCE, DISTANCE_LENGTH = 22, 16
#: Lines of this many characters at most have a bitmap of character pairs, of so many numbers.
GRAM_LENGTH, GRAM_WORDS = 128, 4
TASK_PAIRS = 500             # pairs of long lines that are worth a task of their own
_SIGNS = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def words_of(line: Column) -> Column:
    """A line's normalised words."""
    return F.array_remove(F.split(F.lower(line), _SIGNS), "")


def _identity(docs: DataFrame) -> DataFrame:
    """(_doc, _key, _text): _key stands for (doc_id, text), null-safely."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(doc.alias("_doc"), F.xxhash64(doc, text).alias("_key"), text.alias("_text"))


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("_doc", "_key", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))


_SIGN = np.ones(256, bool)
_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _common_words() -> np.ndarray:
    data, offsets = bw.text_bytes(pa.array(sorted(COMMON), pa.large_string()))
    return np.sort(bw.words(data, offsets, _SIGN)[3])


_COMMON = _common_words()


def _bits(n: np.ndarray) -> np.ndarray:
    """The number of blocks, as a power of two, of lines with ``n`` content words."""
    long_line = np.maximum(LEAST_BITS, np.floor(np.log2(np.maximum(n, 1) / BLOCK_WORDS) + 1e-9)).astype(np.int64)
    return np.where(n < SHORT, SHORT_BITS, long_line)


def _blocks(h: np.ndarray, first: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, line) of the blocks of lines: line i has the distinct content words
    h[first[i]:first[i + 1]], ascending, in 2 ** bits[i] blocks."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    if not len(h):
        return h, owner
    block = h >> (np.uint64(64) - bits.astype(np.uint64))[owner]
    start = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])]))
    votes = np.diff(np.append(start, len(h)))
    line = owner[start]
    with np.errstate(over="ignore"):
        key = bw.mix(np.add.reduceat(bw.mix(h), start) + bits.astype(np.uint64)[line] * bw._STEP[3])
    keep = (votes >= VOTES) | (n[line] < SHORT)
    return key[keep], line[keep]


def _simhash(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The majority of each of 64 bits over consecutive runs of hashes (0 for an empty run)."""
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, first[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * votes > np.diff(first)[some][:, None], axis=1).view(np.uint64).ravel()
    return out


def _pair_maps(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bitmap (``GRAM_WORDS`` numbers) per line of its normalised text's pairs of
    characters, each told by its first byte; line i has the words first[i]:first[i + 1]."""
    size = end - start
    word = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + start[word]
    begins = (data[at] & 0xC0) != 0x80
    sign, word = data[at[begins]].astype(np.uint64), word[begins]
    line = np.repeat(np.arange(len(first) - 1), np.diff(first))[word]
    inside = word[1:] == word[:-1]
    within = line[1:] == line[:-1]
    blank = np.uint64(32)

    def place(a: np.ndarray | np.uint64, b: np.ndarray) -> np.ndarray:
        return bw.mix(a * np.uint64(256) + b) >> np.uint64(64 - (64 * GRAM_WORDS).bit_length() + 1)

    pair = place(sign[:-1], np.where(inside, sign[1:], blank))
    after = place(blank, sign[1:])
    out = np.zeros((len(first) - 1, GRAM_WORDS), np.uint64)
    line = line[:-1]
    heads = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else line
    for k in range(GRAM_WORDS if len(line) else 0):
        bits = np.zeros(len(line), np.uint64)
        for g, held in ((pair, within), (after, within & ~inside)):
            bits |= np.where(held & (g >> np.uint64(6) == k), np.uint64(1) << (g & np.uint64(63)), np.uint64(0))
        out[line[heads], k] = np.bitwise_or.reduceat(bits, heads)
    return out


def _short_texts(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of lines' normalised texts; line i has the words first[i]:first[i + 1], one at least."""
    size = end - start + 1                  # with the blank after it, but for a line's last word
    size[first[1:] - 1] -= 1
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    word = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(word)) - begin[word] + start[word]
    out = np.full(len(word), 32, np.uint8)
    held = at < end[word]
    out[held] = data[at[held]]
    return out, begin[first]


def lines_of(texts: list[str | None], min_words: int, maps: bool = False):
    """(text, line number, node, length, simhash, keys, first) of every line of
    enough words: ``node`` is the hash of its normalised words, ``length`` theirs in
    characters with blanks between, line i's blocks are keys[first[i]:first[i + 1]];
    with ``maps``, of those of at most ``GRAM_LENGTH`` characters the bitmaps of
    character pairs and the (bytes, offsets) of their normalised texts too."""
    lower = [(x or "").lower().encode() for x in texts]
    data = np.frombuffer(b"".join(lower), np.uint8)
    ends = np.cumsum([len(x) for x in lower])
    breaks = np.flatnonzero(data == 10)
    # A line ends at its break or with its text.
    offsets = np.sort(np.concatenate([[0], breaks + 1, ends]))
    text = np.searchsorted(ends, np.concatenate([breaks, ends]), "left")
    text[len(breaks):] = np.arange(len(ends))
    place = np.lexsort((np.concatenate([breaks, ends]), text))
    text = text[place]
    number = np.arange(len(text)) - np.searchsorted(text, text)
    start, end, first, h = bw.words(data, offsets, _SIGN)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) - np.repeat(first[:-1], n)
    with np.errstate(over="ignore"):
        node = bw.mix(_sums(h * bw._powers(int(n.max(initial=0)))[0][place], first) + n.astype(np.uint64) * bw._STEP[2])
    inner = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) == 0x80)])          # bytes that begin no character
    length = _sums(end - start - (inner[end] - inner[start]), first) + n - 1
    # Distinct content words a line, or all of them where there is no other.
    at = np.minimum(np.searchsorted(_COMMON, h), len(_COMMON) - 1)
    content = _COMMON[at] != h
    content |= (_sums(content.astype(np.int64), first) == 0)[owner]
    distinct, begin = bw.distinct_sorted(h[content], np.concatenate([[0], np.cumsum(_sums(content.astype(np.int64), first))]))
    size = np.diff(begin)
    one, two = _bits(size * BORDER), _bits(size / BORDER)
    key, line = _blocks(distinct, begin, one)
    other = np.flatnonzero(one != two)
    more_h = np.concatenate([distinct[begin[i]:begin[i + 1]] for i in other]) if len(other) else distinct[:0]
    more, more_line = _blocks(more_h, np.concatenate([[0], np.cumsum(size[other])]), two[other])
    key, line = np.concatenate([key, more]), np.concatenate([line, other[more_line]])
    order = np.argsort(line, kind="stable")
    keep = n >= max(min_words, 1)
    kept_key = keep[line[order]]
    counts = np.bincount(line, minlength=len(n))[keep]
    found = (text[keep], number[keep], node[keep], length[keep], _simhash(distinct, begin)[keep], key[order][kept_key], np.concatenate([[0], np.cumsum(counts)]))
    if not maps:
        return found
    mapped = keep & (length <= GRAM_LENGTH)
    held = mapped[owner]
    words = start[held], end[held], np.concatenate([[0], np.cumsum(n[mapped])])
    return *found, _pair_maps(data, *words), _short_texts(data, *words)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, 0 for an empty one (wrapping)."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[first[1:]] - total[first[:-1]]


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_doc, _key, _pos, node, size, sim, grams, short, keys) of every line of
    enough words, ``grams`` and ``short`` (the normalised text) null for longer
    lines; map-only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "_text"):
            text, number, node, length, sim, keys, first, maps, (data, ends) = lines_of(part.column("_text").to_pylist(), min_words, maps=True)
            at = pa.array(text)
            mapped = length <= GRAM_LENGTH
            offsets = np.concatenate([[0], np.cumsum(np.where(mapped, GRAM_WORDS, 0))]).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(maps.view(np.int64).ravel()), mask=pa.array(~mapped))
            begin = np.zeros(len(mapped) + 1, np.int32)
            begin[1:][mapped] = np.diff(ends)
            short = pa.StringArray.from_buffers(len(mapped), pa.py_buffer(np.cumsum(begin, dtype=np.int32)), pa.py_buffer(data), pa.array(mapped).buffers()[1])
            blocks = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(part.column(c).combine_chunks().take(at) for c in ("_doc", "_key")), pa.array(number.astype(np.int32)),
                                              pa.array(node.view(np.int64)), pa.array(length.astype(np.int64)), pa.array(sim.view(np.int64)), grams, short, blocks],
                                             names=["_doc", "_key", "_pos", "node", "size", "sim", "grams", "short", "keys"])
    return _identity(docs).mapInArrow(run, "_doc long, _key long, _pos int, node long, size long, sim long, grams array<long>, short string, keys array<long>")


def _aligned(most: str) -> str:
    """SQL: the edits of an alignment of ``x`` and ``y`` word by word, at least
    their distance: each word of x is kept, replaced or deleted, and one or two
    of y's are inserted where that meets an equal word; it ends beyond ``most``."""
    def step(j: str, edits: str) -> str:
        return f"named_struct('i', s.i + 1, 'j', s.j + {j}, 'c', s.c + {edits})"
    gone, put, put_next = "length(w) + 1", "length(get(t.y, s.j)) + 1", "length(get(t.y, s.j + 1)) + 1"
    replaced = step("1", "levenshtein(w, get(t.y, s.j))")
    return f"""element_at(transform(array(named_struct('x', split(x, ' '), 'y', split(y, ' '), 'most', {most})), t ->
        aggregate(t.x, named_struct('i', 0, 'j', 0, 'c', 0), (s, w) -> case
            when s.c > t.most then s
            when get(t.y, s.j) = w then {step("1", "0")}
            when s.j >= size(t.y) then {step("0", gone)}
            when get(t.x, s.i + 1) = get(t.y, s.j + 1) then {replaced}
            when get(t.y, s.j + 1) = w then {step("2", put)}
            when get(t.x, s.i + 1) = get(t.y, s.j) then {step("0", gone)}
            when get(t.y, s.j + 2) = w then {step("3", f"{put} + {put_next}")}
            when get(t.x, s.i + 2) = get(t.y, s.j) then {step("0", gone)}
            else {replaced} end,
        s -> aggregate(slice(t.y, s.j + 1, size(t.y)), s.c, (c, w) -> c + {gone}))), 1)"""


def line_links(docs: DataFrame, lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): linked normalised lines (nodes) among the lines of ``line_table``."""
    spark = docs.sparkSession
    # Entries move to their blocks once; a block that is shared is told by two numbers, whatever its number of lines.
    keyed = lines.select(F.explode("keys").alias("key"), "node").repartition("key")
    shared = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    met = materialize(keyed.join(shared.hint("shuffle_hash"), "key").distinct())
    free_shuffles(spark)
    # Any occurrence shows a node's text: the place of the first is kept.
    nodes = materialize(lines.join(met.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        (-F.count(F.lit(1))).alias("rank"), *[F.min(c).alias(c) for c in ("size", "sim", "grams", "short")], F.min(F.struct("_key", "_pos")).alias("place")))
    free_shuffles(spark)

    def side(name: str) -> DataFrame:
        return nodes.select(*[F.col(c).alias(f"{name}_{c}") for c in ("node", "size", "sim", "grams", "short")])

    most = f"cast(floor((1 - {similarity}) * greatest(length(x), length(y)) + 1e-9) as int)"
    near = f"{_aligned(most)} <= {most} or levenshtein(x, y, {most}) >= 0"
    edits = f"cast(floor((1 - {similarity}) * greatest(l_size, r_size) + 1e-9) as int)"
    both = "l_short is not null and r_short is not null"
    # Two short lines bring their texts: their pair is decided where it meets.
    like = (f"least(l_size, r_size) >= {similarity} * greatest(l_size, r_size) - 1e-9 and "
            f"(least(l_size, r_size) < {DISTANCE_LENGTH} or bit_count(l_sim ^ r_sim) <= {DISTANCE}) and (l_grams is null or r_grams is null or "
            + " + ".join(f"bit_count(l_grams[{k}] ^ r_grams[{k}])" for k in range(GRAM_WORDS))
            + f" <= 4 * {edits}) and (l_short is null or r_short is null or levenshtein(l_short, r_short, {edits}) >= 0)")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(node, norm) of nodes (distinct): each document is read once for all lines that it shows."""
        place = nodes.join(wanted, "node", "left_semi").select("place._key", F.struct("place._pos", "node").alias("at"))
        want = materialize(place.groupBy("_key").agg(F.collect_list("at").alias("want")))
        rows = _identity(docs).join(small(want, weight=F.size("want")), "_key")
        rows = rows.selectExpr("""inline(element_at(transform(array(named_struct('parts', split(_text, '\n'), 'want', want)), t ->
            transform(t.want, w -> named_struct('node', w.node, '_line', get(t.parts, w._pos)))), 1))""")
        return materialize(rows.select("node", F.array_join(words_of(F.col("_line")), " ").alias("norm")).dropDuplicates(["node"]))

    def linked(pairs: DataFrame) -> DataFrame:
        """The links among pairs (l_, r_) of entries that are alike."""
        pairs = compact(materialize(pairs.where(like).select(F.col("l_node").alias("a"), F.col("r_node").alias("b"), F.expr(both).alias("sure")).distinct()))
        sure, p = pairs.where("sure").select("a", "b"), pairs.where("not sure").select("a", "b")
        n = p.count()
        if not n:
            return sure
        # The pairs (two numbers each) travel to the texts; a pair's second text and each pivot's move once.
        texts = texts_of(p.select("a").unionByName(p.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "node"))
        others = texts.join(p, F.col("node") == F.col("b")).select("a", "b", F.col("norm").alias("y")).repartition(-(-n // TASK_PAIRS), "a")
        hubs = texts.select(F.col("node").alias("a"), F.col("norm").alias("x"))
        p = others.join(hubs, "a").where(f"abs(length(x) - length(y)) <= {most}").where(near).select("a", "b")
        return materialize(sure.unionByName(p))

    # Each block's members are compared with its pivot, the most frequent line.
    ranked = met.join(nodes.select("node", "rank"), "node")
    pivot = materialize(ranked.groupBy("key").agg(F.min(F.struct("rank", "node")).alias("p")).select("key", F.col("p.node").alias("pivot")))
    pairs = met.join(pivot, "key").where("node <> pivot").select(F.col("pivot").alias("l_node"), F.col("node").alias("r_node")).distinct()
    links = compact(linked(pairs.join(side("l"), "l_node").join(side("r"), "r_node")))
    free_shuffles(spark)
    # What is left of a block, in more than one component, is compared across them; the
    # sizes of a linked pair are one band apart at most (a little wider, for rounding).
    comp = materialize(components(links))
    left = (met.join(pivot, "key").where("node <> pivot").drop("pivot").join(small(comp), "node", "left")
            .select("key", "node", F.coalesce("component", "node").alias("comp")))
    left = materialize(left)
    many = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    left = compact(materialize(left.join(many, "key", "left_semi")))
    del pivot, pairs, comp, many
    free_shuffles(spark)
    if left.isEmpty():
        return links
    band = F.floor(F.log(F.greatest(F.col("l_size"), F.lit(1))) / math.log(1.26))
    entry = left.withColumnRenamed("node", "l_node").join(side("l"), "l_node").withColumn("band", band)
    other = entry.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    other = other.select("key", "band", *[F.col(c).alias(c if c in ("key", "band") else "r_comp" if c == "comp" else f"r_{c[2:]}") for c in entry.columns if c not in ("key", "band")])
    return links.unionByName(linked(entry.join(other, ["key", "band"]).where("comp <> r_comp and (l_size, l_node) < (r_size, r_node)")))


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(_key, gone): the line numbers (from 0) that each document loses."""
    occurrences = materialize(line_table(docs, min_words))
    comp = materialize(components(line_links(docs, occurrences, similarity)))
    repeated = occurrences.groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    grouped = (repeated.join(comp, "node", "left").where("component is not null or copies > 1")
               .select("node", F.coalesce("component", "node").alias("component")))
    held = occurrences.join(small(materialize(grouped)), "node").select("component", F.struct("_doc", "_key", "_pos").alias("at"))
    held = materialize(held)
    keep = held.groupBy("component").agg(F.min("at").alias("keep"))
    gone = held.join(keep, "component").where("not (at <=> keep)").select("at._key", "at._pos")
    return materialize(gone.groupBy("_key").agg(F.collect_set("_pos").alias("gone")))


def _kept_text(docs: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """(row, kept, n, gone): each row of docs whole, its remaining text, its
    lines and how many of them go."""
    lost = removed_lines(docs, min_words, similarity).withColumnRenamed("gone", "lost")
    held = lost.agg(F.sum(F.size("lost"))).first()[0] or 0
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).withColumn("_key", F.xxhash64(F.col("row.doc_id").cast("long"), text))
    rows = rows.join(F.broadcast(lost) if held <= BROADCAST_ROWS else lost, "_key", "left")
    parts = F.split(text, "\n")
    kept = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains(F.col("lost"), i)), "\n")
    return rows.select("row", F.when(F.col("lost").isNull(), text).otherwise(kept).alias("kept"), F.size(parts).cast("long").alias("n"),
                       F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("gone"))


def report(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """-> (doc_id, n_lines, n_removed, text): each document with its remaining lines."""
    return _kept_text(docs.select("doc_id", "text"), min_words, similarity).select(
        "row.doc_id", F.col("n").alias("n_lines"), F.col("gone").alias("n_removed"), F.col("kept").alias("text"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (all columns) with their remaining lines as text."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return _kept_text(docs, min_words, similarity).select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])
