import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import Groups, edge_docs, edge_rows, no_docs
from quire.llm import bytewords as bw
from quire.llm import queries, spotsigs


def check(rows, texts):
    texts = sorted(((-(1 << 63) if i is None else i, x or "") for i, x in texts), key=lambda r: (r[0], r[1].encode()))
    rows = sorted(rows, key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256))
    want = []
    for k, (i, x) in enumerate(texts):
        nxt = texts[(k + 1) % len(texts)][1]
        half = len(x) // 2
        want.append((i, len(x), hashlib.sha256((x[:len(x) - half] + nxt[:half]).encode()).hexdigest()))
    assert sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(want)

    def spots(fp):
        return {fp[j:j + 12] for j in range(0, len(fp), 12)}
    for r in rows:
        a, b = spots(r.fingerprint), spots(r.edited_fingerprint)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r.near_next <= 1 and r.n_spots == len(a)


@pytest.mark.parametrize("pieces", [1, 5])
def test_order_whatever_the_ranges(llm, docs, pieces, monkeypatch):
    monkeypatch.setattr(spotsigs, "partitions", lambda spark: pieces)
    check(spotsigs.edited_fingerprints(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_next_likeness_and_equal_texts(llm, sf, docs):
    rows = queries.QUERIES["op2_spotsigs"](llm, sf).orderBy("doc_id").collect()
    text = dict(map(tuple, docs.select("doc_id", "text").collect()))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    for a, b in zip(rows, rows[1:]):
        if text[a.doc_id] == text[b.doc_id]:
            assert a.near_next == 1.0
    plain = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(docs).collect()}
    assert plain == {r.doc_id: r.fingerprint for r in rows}


def test_edges(llm):
    check(spotsigs.edited_fingerprints(edge_docs(llm)).collect(), edge_rows())
    assert spotsigs.edited_fingerprints(no_docs(llm)).count() == 0
    one = spotsigs.edited_fingerprints(edge_docs(llm).where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def all_pairs(texts, threshold):
    """doc_id -> smallest doc_id of its component, by all pairs of signature sets."""
    v, first = spotsigs.signatures(*bw.text_bytes(pa.array([x or "" for _, x in texts], pa.large_string())))
    sets = [set(v[a:b].tolist()) for a, b in zip(first, first[1:])]
    groups = Groups(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                groups.link(i, j)
    out = {}
    for i, (doc, _) in enumerate(texts):
        out.setdefault(groups.find(i), []).append(doc)
    return sorted((d, min(members)) for members in out.values() for d in members), sum(len(m) > 1 for m in out.values())


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_near_groups_are_those_of_all_pairs(llm, docs, threshold):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, groups = all_pairs(texts, threshold)
    assert sorted((r.doc_id, r.component_id) for r in spotsigs.near_groups(docs, threshold).collect()) == want and groups > 3


def test_near_groups_of_odd_rows(llm):
    frame = edge_docs(llm).where("doc_id is not null")
    got = sorted((r.doc_id, r.component_id) for r in spotsigs.near_groups(frame).collect())
    want, _ = all_pairs([r for r in edge_rows() if r[0] is not None], 0.8)
    assert got == want
    assert spotsigs.near_groups(no_docs(llm)).count() == 0


def test_signatures_depend_on_the_text_alone():
    texts = ["The stone of a river. And then", "", "Über the hill and far", "The stone of a river. And then"]
    v, first = spotsigs.signatures(*bw.text_bytes(pa.array(texts)))
    each = [spotsigs.signatures(*bw.text_bytes(pa.array([x])))[0].tolist() for x in texts]
    assert [v[a:b].tolist() for a, b in zip(first, first[1:])] == each and each[0] == each[3] and each[1] == []


def plain_spots(text):
    """The chains of a text, read word by word: (anchor or None for a sentence start, next content words)."""
    word, stop, out, words, fresh = "", False, set(), [], True
    for c in text.translate({c: c + 32 for c in range(65, 91)}) + "\n":
        if c.isascii() and not c.isalnum():
            if word:
                words.append((word, fresh))
                word, fresh = "", False
            if c in ".!?\n":
                fresh = True
        else:
            word += c
    content = [i for i, (w, _) in enumerate(words) if w not in spotsigs.COMMON]
    for i, (w, opens) in enumerate(words):
        if w in spotsigs.COMMON:
            out.add((w, *[words[k][0] for k in content if k > i][:spotsigs.CHAIN]))
        if opens:
            out.add((None, *[words[k][0] for k in content if k >= i][:spotsigs.CHAIN]))
    return out


def test_signatures_are_the_chains_of_a_plain_reading(docs):
    """One signature a chain: as many as a plain reading finds, equal where its chains are."""
    texts = [r.text or "" for r in docs.collect()] + ["The stone of a river. And then! of", "", "of of the", "x", "ÉTÉ été. The É", "a.b.the c"]
    v, first = spotsigs.signatures(*bw.text_bytes(pa.array(texts, pa.large_string())))
    plain = [plain_spots(x) for x in texts]
    code = {}
    for k, chains in enumerate(plain):
        own = set(v[first[k]:first[k + 1]].tolist())
        assert len(own) == len(chains)
        for c in chains:
            # A chain's signature is in every text that has the chain, and one of its own exists.
            code[c] = code[c] & own if c in code else own
    assert all(code.values())
