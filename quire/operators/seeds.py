"""Seeds of search terms (J5, J7): one run of bytes of each term, by which the
term and the texts that may hold it meet in an equi-join.

A seed has ``LONGEST`` bytes (UTF-8), or is the whole term where that is
shorter; of a term's runs it is the one that the fewest other terms share
(ties: the smallest), so seeds tell terms apart.  Its code is one number, its
bytes behind their count, so equal codes are equal runs.  A text offers the
codes of its runs of the lengths that occur.  Nearly all of them are nobody's
seed: a bitmap of the seeds, made by one aggregation (``BITS`` bits whatever the
number of terms), is tested before runs become rows.  Texts are read as arrays
of bytes, a stretch of ``STRETCH`` bytes at a time, whatever a text's length.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LONGEST = 7                   # a code has its run's length in the byte above
BITS = 1 << 18
WORD = 32                     # bits of one number of the bitmap
STRETCH = 1 << 17             # bytes looked at together
#: Bounds within which a seeded term table is sent to every task.
SMALL_TERMS = 200_000
SMALL_BYTES = 32 << 20


def _mixed(codes: np.ndarray, bits: int) -> np.ndarray:
    """The codes' places in a table of 2 ** ``bits``."""
    return ((codes ^ (codes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _place(codes: np.ndarray) -> np.ndarray:
    return _mixed(codes, BITS.bit_length() - 1)


def _once(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without most repeats of a (row, code): of all that fall on one place of a
    table the last stays, and whatever differs from it."""
    place = _mixed(codes + rows.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), 17)
    table = np.empty(1 << 17, np.int64)
    order = np.arange(len(codes))
    table[place] = order
    last = table[place]
    keep = (last == order) | (codes[last] != codes) | (rows[last] != rows)
    return rows[keep], codes[keep]


def found_codes(texts: pa.Array, lengths: list[int], known: np.ndarray) -> pa.Array:
    """Per text the distinct codes of its runs of ``lengths`` bytes whose place
    is ``known``; none for a null text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    rows, codes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    longest = max(lengths)
    for start in range(bounds[0], bounds[-1], STRETCH):
        stop = min(start + STRETCH + longest - 1, bounds[-1])
        first, last = np.searchsorted(bounds, start, "right") - 1, np.searchsorted(bounds, stop, "left")
        row = np.repeat(np.arange(first, last), np.diff(np.clip(bounds[first:last + 1], start, stop)))
        signs = data[start:stop].astype(np.uint64)
        run = signs
        for n in range(1, longest + 1):
            if n > 1:
                run = (run[:-1] << np.uint64(8)) | signs[n - 1:]
            if n in lengths:
                code = run[:STRETCH] | np.uint64(n << 56)
                at = np.flatnonzero(known[_place(code)])
                at = at[row[at] == row[at + n - 1]]            # within one text
                r, c = _once(row[at], code[at])
                rows.append(r)
                codes.append(c)
    row, code = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    row, code = row[new], code[new]
    ends = np.searchsorted(row, np.arange(len(texts) + 1), "left")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code.view(np.int64)))


def _places(codes: pa.Array) -> pa.Array:
    return pa.array(_place(codes.to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64))


def _length(seed: Column) -> Column:
    return F.shiftright(seed, 56).cast("int")


def seeded_terms(terms: DataFrame) -> DataFrame:
    """Distinct ``(term, lt)`` -> ``(term, lt, _seed)``; materialised (a term
    table is small beside the texts, and it is read three times)."""
    signs = F.col("lt").cast("binary")
    n = F.least(F.lit(LONGEST), F.octet_length("lt"))
    codes = F.transform(F.sequence(F.lit(1), F.octet_length("lt") - n + 1), lambda at: F.conv(F.hex(F.substring(signs, at, n)), 16, 10).cast("long")
                        + F.call_function("shiftleft", n.cast("long"), F.lit(56)))
    runs = terms.select("term", "lt", F.explode(F.array_distinct(codes)).alias("_seed"))
    shared = runs.groupBy("_seed").agg(F.count(F.lit(1)).alias("_n"))
    best = runs.select("term", "lt", "_seed").join(shared, "_seed").groupBy("term", "lt").agg(F.min(F.struct("_n", "_seed")).alias("_s"))
    return materialize(best.select("term", "lt", F.col("_s._seed").alias("_seed")))


@dataclass
class SeedTable:
    lengths: list[int]        # of the seeds that occur
    words: list[int]          # the bitmap
    small: bool               # may the term table be sent to every task?

    @classmethod
    def of(cls, seeded: DataFrame) -> SeedTable:
        """What the driver needs to know of a term table: at most ``BITS / WORD``
        numbers, seven lengths and two counts."""
        told = seeded.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") + F.octet_length("lt")).alias("b"),
                          F.sort_array(F.collect_set(_length(F.col("_seed")))).alias("lengths")).first()
        words = [0] * (BITS // WORD)
        if told["n"]:
            place = F.col("place")
            bits = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD)).cast("int"))
            places = seeded.select(F.arrow_udf(_places, "long")("_seed").alias("place"))
            for r in places.groupBy(F.floor(place / WORD).alias("w")).agg(F.bit_or(bits).alias("bits")).collect():
                words[r["w"]] = r["bits"]
        return cls(told["lengths"], words, told["n"] <= SMALL_TERMS and (told["b"] or 0) <= SMALL_BYTES)

    def runs(self, text: Column) -> Column:
        """The distinct runs of a text that may be a seed, as codes."""
        lengths, packed = self.lengths, np.array(self.words, "<u4").tobytes()

        @F.arrow_udf("array<long>")
        def found(texts: pa.Array) -> pa.Array:
            known = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").view(bool)
            return found_codes(texts, lengths, known)

        return found(text)


def is_whole(term: str) -> Column:
    """Is the seed the term itself, so that a text that holds one holds the other?"""
    return F.octet_length(term) <= LONGEST
