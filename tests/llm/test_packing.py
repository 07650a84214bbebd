import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import edge_docs, edge_rows, no_docs
from quire.llm import packing
from quire.llm.word_tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = WordTokens(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcsdtrevlm'’ \n\t.,;!012ÀéßÿÖ×÷¿ªµ½—“<|>"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_ids_are_the_library_s(texts):
    ids, first = OURS.encode_texts(texts)
    for i, x in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == LIBRARY.encode(x, add_special_tokens=False).ids


def check(rows, texts):
    """rows of a packing; texts: (doc_id, text) list."""
    want = defaultdict(list)
    for i, x in texts:
        want[i].append(ids_of(x))
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for r in members:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0          # no padding at all
        assert len({(r.tier, r.step_group) for r in members}) == 1
    assert set(pieces) == set(want)
    for doc, got in pieces.items():
        tokens = sum(len(x) for x in want[doc])
        assert sum(r.length for r in got) == tokens
        if len(want[doc]) == 1:
            ids = np.array(want[doc][0], "<u4")
            at = 0
            for r in sorted(got, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids))
                assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
                at += r.length


def test_table(docs):
    check(packing.pack(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_small_batches_and_edges(llm):
    check(packing.pack(edge_docs(llm), batch_tokens=300).collect(), edge_rows())
    assert packing.pack(no_docs(llm)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60))
def test_windows_are_filled_exactly(lengths):
    closed, left = packing.plan_windows([(i, 0, n) for i, n in enumerate(lengths)])
    used = defaultdict(list)
    for tier, pieces in closed + packing.close_rest(left):
        assert sum(p[2] for p in pieces) == tier
        for d, s, n in pieces:
            used[d].append((s, n))
    for i, n in enumerate(lengths):
        at = 0
        for s, m in sorted(used[i]):
            assert s == at
            at += m
        assert at == n


def test_step_groups_hold_one_tier_and_equal_tokens():
    seqs = [(512, [(i, 0, 512)]) for i in range(100)] + [(2048, [(i, 0, 1024), (i, 0, 1024)]) for i in range(40)]
    groups = defaultdict(list)
    for g, (tier, _) in zip(packing.step_groups(seqs), seqs):
        groups[g].append(tier)
    assert all(len(set(t)) == 1 and sum(t) <= packing.STEP_TOKENS for t in groups.values())
