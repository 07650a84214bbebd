"""Token counts of whole texts and of every prefix, by prefix dynamic programming.

A byte pair encoding is settled by its neighbours: a token sequence is the
encoding of its text exactly if every two neighbouring tokens, joined, encode
to themselves.  So each prefix of a piece has one last token that fits behind
the encoding of what comes before it, and its count is that shorter prefix's
count plus one.  A piece's end carries the vocabulary's word-end suffix, so
each prefix is closed with a fitting closing token.  Pieces do not influence
each other, and a text's counts are its pieces' counts one after another.

``prefix_table`` stores for each text one signed byte a code point: by how much
the token count changes when the prefix grows by it.  ``answers`` and
``tokens_at`` then tell totals, whether a text is over a limit, where a
truncation to the limit ends and the count of any prefix from the stored bytes
alone, without the vocabulary.

A prefix is one of the text as the vocabulary's rule normalises it (NFC, white
space to one blank, lower case); its count is what the library gives for that
prefix as a text of its own.  Special strings inside a text are one token, as
the library's default is; a prefix that ends inside one is ordinary text.

Defined results: a null text is an empty text with no token; white space alone
has no token; each repeated row is answered alike; very long texts and pieces
take time and memory in proportion to their length; other columns are ignored;
an empty table gives no row.
"""
from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from .common import chunked

LIMIT = 2048
#: Stretches between blanks (each half of the store) and pairs of tokens that a
#: worker keeps; what is met again stays.
KEPT_UNITS = 300_000
KEPT_PAIRS = 250_000
#: Characters up to which a stretch is kept.
KEPT_LENGTH = 48
OPEN, CLOSES = 1, 2
CHUNK_BYTES = 512 << 10

TABLE = "doc_id long, n_bytes long, steps binary"
ANSWERS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"

#: Texts without any other character need no library for normalising and
#: splitting: ASCII, Latin letters and signs without combining marks, dashes
#: and quotes.
_ODD = re.compile("[^\t\n\r -~¡-¬®-įı-ſ‐-‧]")
BLANKS = "\t\n\r "


class PrefixTokens:
    """Token counts of all prefixes with the vocabulary in ``path`` (the split
    rule is read from the file, its word-end suffix too)."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.kinds: dict[str, int] = {}           # a token's letters -> stands inside a piece, at its end
        for t in vocab:
            if t.endswith(self.suffix):
                t = t[:len(t) - len(self.suffix)]
                self.kinds[t] = self.kinds.get(t, 0) | CLOSES
            if not self.suffix or t in vocab:
                self.kinds[t] = self.kinds.get(t, 0) | OPEN
        self.longest = max(map(len, self.kinds))
        self.close_model = Tokenizer(self.whole.model)
        self.open_model = Tokenizer(models.BPE(vocab=vocab, merges=[tuple(m) for m in model["merges"]]))
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.split = regex.compile(splits[0])
        special = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.alphabet = self._byte_alphabet()
        self._forget()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _byte_alphabet() -> list[str]:
        from .word_tokens import _byte_alphabet
        return [chr(c) for _, c in sorted(_byte_alphabet().items())]

    def _fits(self, behind: dict, right: str, kind: int) -> int:
        """Whether ``right`` is the next token, and the last one, where the open
        encoding so far ends in the token that ``behind`` belongs to: it is if
        the two, joined, encode to just these two."""
        left, out = behind[""], 0
        for place, model, end in ((OPEN, self.open_model, ""), (CLOSES, self.close_model, self.suffix)):
            if kind & place and model.encode([left + right], is_pretokenized=True).tokens == [t for t in (left, right + end) if t]:
                out |= place
        behind[right] = out
        self.n_pairs += 1
        return out

    def piece_counts(self, piece: str) -> list[int]:
        """Token counts of all prefixes of one piece, by code points.  What the
        piece before had in common with this one is not computed again."""
        if piece.isascii() and piece.isprintable():
            s, ends = piece, range(1, len(piece) + 1)      # these stand for themselves
        else:
            units = [[self.alphabet[b] for b in c.encode()] for c in piece]
            s = "".join(u for unit in units for u in unit)
            ends = np.cumsum([len(u) for u in units]).tolist()
        if self.n_pairs >= KEPT_PAIRS:
            self._forget()
        before, behind, count, closed = self.state
        same = min(len(os.path.commonprefix((before, s))), len(behind) - 1)
        del behind[same + 1:], count[same + 1:], closed[same:]
        at = None if len(ends) == len(s) else set(ends)
        kinds, longest, known, size = self.kinds, self.longest, self.known, len(s)
        for i in range(same + 1, size + 1):
            # Inside a code point no prefix ends; behind the last one nothing goes on.
            want = (CLOSES if at is None or i in at else 0) | (OPEN if i < size else 0)
            ended = 0
            for j in range(i - 1, max(0, i - longest) - 1, -1):
                t = s[j:i]
                fits = behind[j].get(t)
                if fits is None:
                    if t not in kinds:
                        continue
                    fits = self._fits(behind[j], t, kinds[t])
                fits &= want
                if fits:
                    if fits & CLOSES:
                        ended = count[j] + 1
                    if fits & OPEN:
                        after = known.get(t)
                        if after is None:
                            after = known[t] = {"": t}
                        behind.append(after)
                        count.append(count[j] + 1)
                    want &= ~fits
                    if not want:
                        break
            closed.append(ended)
        self.state = (s, behind, count, closed)
        out = list(closed) if at is None else [closed[e - 1] for e in ends]
        if size > KEPT_LENGTH:
            self.state = ("", [self.known[""]], [0], [])
        return out

    def _forget(self) -> None:
        #: Token -> what is known of the tokens behind it ('' -> the token itself).
        self.known: dict[str, dict] = {"": {"": ""}}
        self.n_pairs = 0
        #: The last piece, what is behind each of its prefixes' open encodings,
        #: their counts and the closed counts.
        self.state: tuple[str, list[dict], list[int], list[int]] = ("", [self.known[""]], [0], [])

    def piece_steps(self, piece: str) -> bytes:
        counts = self.piece_counts(piece)
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
            counts[1] = 2                         # a contraction's sign and first letter are two pieces
        return bytes([(b - a) & 255 for a, b in pairwise([0, *counts])])

    def _known(self, unit: str) -> bytes | None:
        """Steps of a unit kept in the young or the old half of the store."""
        got = self.young.get(unit)
        if got is None and (got := self.old.get(unit)) is not None:
            self._keep(unit, got)
        return got

    def _keep(self, unit: str, steps: bytes) -> bytes:
        if len(unit) <= KEPT_LENGTH:
            if len(self.young) >= KEPT_UNITS:
                self.young, self.old = {}, self.young
            self.young[unit] = steps
        return steps

    def _unit(self, unit: str) -> bytes:
        """Steps of a stretch without white space."""
        got = self._known(unit)
        if got is not None:
            return got
        pieces = [unit] if unit.isalpha() else self.split.findall(unit)
        if len(pieces) == 1:
            return self._keep(unit, self.piece_steps(unit))
        out = []
        for p in pieces:
            known = self._known(p)
            out.append(self._keep(p, self.piece_steps(p)) if known is None else known)
        return self._keep(unit, b"".join(out))

    def _gap(self, text: str) -> tuple[bytes, str]:
        """Steps of a text without special strings, and its last piece."""
        if not _ODD.search(text):
            units = text.lower().split()
            if not units:
                return b"\0" * bool(text), ""
            got = list(map(self.young.get, units))
            if None in got:
                missing = {u for u, steps in zip(units, got) if steps is None}
                found = {u: self._unit(u) for u in sorted(missing)}        # neighbours share their beginnings
                got = [found[u] if steps is None else steps for u, steps in zip(units, got)]
            last = "" if text[-1] in BLANKS else units[-1]
            tail = self.split.findall(last)[-1:] if len(last) <= KEPT_LENGTH else [last]
            return b"\0" * (text[0] in BLANKS) + b"\0".join(got) + b"\0" * (text[-1] in BLANKS), "".join(tail)
        text = self.whole.normalizer.normalize_str(text)
        out, end, piece = [], 0, ""
        for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(text):
            piece = text[a:b]
            known = self._known(piece)
            out += [b"\0" * (a - end), self._keep(piece, self.piece_steps(piece)) if known is None else known]
            end = b
        return b"".join([*out, b"\0" * (len(text) - end)]), piece if end == len(text) else ""

    def _special_steps(self, before: str, special: str) -> bytes:
        """Steps along a special string that stands behind the piece ``before``."""
        signs = before if before.strip() and not regex.search(r"[\p{L}\p{N}\s]", before) else ""
        lengths = [len(self.whole.encode(signs + special[:k], add_special_tokens=False).ids) for k in range(len(special))]
        return np.diff([*lengths, lengths[0] + 1]).astype(np.int8).tobytes()

    def steps(self, text: str) -> bytes:
        """Change of the token count at each code point of the normalised text."""
        cuts = [m.span() for m in self.special.finditer(text)] if "<|" in text else []
        out, end = [], 0
        for a, b in cuts:
            got, tail = self._gap(text[end:a])
            out += [got, self._special_steps(tail, text[a:b])]
            end = b
        return b"".join([*out, self._gap(text[end:])[0]])


@functools.cache
def _counter(tokenizer: str) -> PrefixTokens:
    """A worker's counter: what it has kept serves all tasks of the worker."""
    import public_tokenizers
    return PrefixTokens(tokenizer if os.path.exists(tokenizer) else public_tokenizers.path(tokenizer))


def prefix_table(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes (UTF-8), steps; map-only.

    ``tokenizer`` names a file of the installed public vocabularies, or is a
    path that every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for part in chunked(batches, "text", CHUNK_BYTES):
            texts = part.column("text")
            size = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64()).combine_chunks()
            steps = pa.array([counter.steps(x) if x else b"" for x in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), size, steps], names=["doc_id", "n_bytes", "steps"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, TABLE)


def counts(steps: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2 ... code points."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def answers(table: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A prefix table -> one row a document: its tokens, whether they are more
    than ``limit``, and the longest prefix (code points) within the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, fit = [], []
            for raw in batch.column(2):
                c = counts(memoryview(raw.as_buffer()))
                total.append(int(c[-1]))
                fit.append(len(c) - 1 - int(np.argmax(c[::-1] <= limit)))
            over = pa.array([n > limit for n in total], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64()), over, pa.array(fit, pa.int64())],
                                             names=[x.split()[0] for x in ANSWERS.split(", ")])

    return table.select("doc_id", "n_bytes", "steps").mapInArrow(run, ANSWERS)


def tokens_at(asked: DataFrame) -> DataFrame:
    """Rows (doc_id, steps, position) -> doc_id, position, n_tokens: the count
    of the prefix of ``position`` code points (beyond the end: of the whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for raw, p in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                c = counts(memoryview(raw.as_buffer()))
                got.append(int(c[min(max(p or 0, 0), len(c) - 1)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.int64())], names=["doc_id", "position", "n_tokens"])

    return asked.selectExpr("cast(doc_id as long) as doc_id", "steps", "cast(position as long) as position").mapInArrow(run, "doc_id long, position long, n_tokens long")
