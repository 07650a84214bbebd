"""Token ids of whole texts with a public word-level BPE vocabulary.

The vocabulary's rule is: NFC, white space to one blank, lower case, split
into contractions, letter runs, single digits and runs of other signs, then
byte pair merges inside each piece.  Pieces repeat, so each distinct piece is
merged once a worker and kept in a table of hashes; pieces are found and
looked up with whole-array operations.  Texts with a character outside the
ranges where the rule is a plain byte rule go to the tokenizer library whole.
"""
from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from . import bytewords as bw

_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
#: Distinct pieces that a worker keeps (about 40 bytes each).
TABLE_PIECES = 3_000_000


def _byte_alphabet() -> dict[int, int]:
    """The visible stand-in character of each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[97:123] = _LETTER
_PLAIN = np.zeros(256, bool)
_PLAIN[32:127] = True
_PLAIN[[9, 10, 13]] = True


class WordTokens:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.whole.model)
        self.alphabet = _byte_alphabet()
        self._reset()

    def _reset(self) -> None:
        self.hashes = np.zeros(0, np.uint64)      # sorted
        self.row = np.zeros(0, np.int64)          # of the rows below
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): ids of all texts in order, text i owns first[i]:first[i+1]."""
        n = len(offsets) - 1
        data = bw.LOWER[data]
        size = len(data)
        nxt = np.concatenate([data[1:], np.zeros(1, np.uint8)])
        nxt2 = np.concatenate([data[2:], np.zeros(2, np.uint8)])[:size]
        cls = _CLASS[data]
        ok = _PLAIN[data]
        # Latin-1 letters (two bytes each); the signs at 97 and B7 are not letters.
        lead = np.flatnonzero(data == 0xC3)
        lead = lead[(lead + 1 < size)]
        second = data[lead + 1]
        up = (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        data[lead[up] + 1] += 0x20
        letter = (second != 0x97) & (second != 0xB7)
        ok[lead] = ok[lead + 1] = True
        cls[lead[letter]] = cls[lead[letter] + 1] = _LETTER
        # Latin-1 signs without the letters, digits and blanks among them.
        lead = np.flatnonzero(data == 0xC2)
        lead = lead[lead + 1 < size]
        lead = lead[(nxt[lead] >= 0xA1) & ~np.isin(nxt[lead], [0xAA, 0xB5, 0xBA, 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE])]
        ok[lead] = ok[lead + 1] = True
        # General punctuation 2010 to 2027 (dashes, quotes, dots).
        lead = np.flatnonzero((data == 0xE2) & (nxt == 0x80) & (nxt2 >= 0x90) & (nxt2 <= 0xA7))
        ok[lead] = ok[lead + 1] = ok[lead + 2] = True
        ok &= ~((data == 60) & (nxt == 124))     # "<|" may begin a special token
        plain = bw.per_text_sum(~ok, offsets) == 0

        border = np.zeros(size + 1, bool)
        border[offsets] = True
        cut = border.copy()
        if size:
            cut[1:size] |= cls[1:] != cls[:-1]
            cut[:size] |= cls == _DIGIT
        quote = np.flatnonzero((data == 39) & cut[:size])
        quote = quote[~border[quote + 1]]
        a, b = nxt[quote], nxt2[quote]
        one = np.isin(a, [115, 116, 109, 100])
        two = ((a == 114) & (b == 101) | (a == 118) & (b == 101) | (a == 108) & (b == 108)) & ~border[np.minimum(quote + 2, size)]
        cut[quote[one | two] + 1] = False
        cut[quote[one] + 2] = True
        cut[quote[two] + 3] = True
        at = np.flatnonzero(cut)
        start, end = at[:-1], at[1:]
        keep = cls[start] != _SPACE if size else np.zeros(0, bool)
        start, end = start[keep], end[keep]
        first = np.searchsorted(start, offsets)
        if not plain.all():
            keep = np.repeat(plain, np.diff(first))
            start, end = start[keep], end[keep]
            first = np.searchsorted(start, offsets)
        rows = self._rows(data, start, end)
        length = self.begin[rows + 1] - self.begin[rows]
        done = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        ids = self.ids[np.arange(done[-1]) + np.repeat(self.begin[rows] - done[:-1], length)]
        out_first = done[first]
        if plain.all():
            return ids, out_first
        parts, count = [], np.diff(out_first)
        raw = data.tobytes()
        for i in range(n):
            if plain[i]:
                parts.append(ids[out_first[i]:out_first[i + 1]])
            else:
                parts.append(np.array(self.whole.encode(self._original(i), add_special_tokens=False).ids, np.uint32))
                count[i] = len(parts[-1])
        del raw
        return np.concatenate(parts) if parts else ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        self._original = lambda i: texts[i]
        return self.encode(*bw.text_bytes(pa.array(texts, pa.large_string())))

    def encode_column(self, col) -> tuple[np.ndarray, np.ndarray]:
        self._original = lambda i: col[i].as_py() or ""
        return self.encode(*bw.text_bytes(col))

    def _rows(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The table's row of each piece; new pieces are merged and added."""
        if not len(start):
            return np.zeros(0, np.int64)
        unique, where, inverse = np.unique(bw.span_hash(bw.prefix(data), start, end), return_index=True, return_inverse=True)
        if len(self.hashes) + len(unique) > TABLE_PIECES:
            self._reset()
        at = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == unique[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes().decode("latin-1").translate(self.alphabet)
            s, e = start[where[new]].tolist(), end[where[new]].tolist()
            got = self.pieces.encode([raw[x:y] for x, y in zip(s, e)], is_pretokenized=True, add_special_tokens=False)
            count = np.bincount(np.array(got.word_ids, np.int64), minlength=len(new))
            rows = len(self.begin) - 1 + np.arange(len(new))
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(count)])
            self.ids = np.concatenate([self.ids, np.array(got.ids, np.uint32)])
            self.hashes = np.insert(self.hashes, at[new], unique[new])
            self.row = np.insert(self.row, at[new], rows)
            at = np.searchsorted(self.hashes, unique)
        return self.row[at][inverse]
