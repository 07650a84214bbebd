import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import edge_docs, edge_rows, no_docs, prose
from quire.llm import passage_dedup, queries


def brute(texts, length=100):
    seen, out = set(), {}
    for i, x in sorted(texts):
        b = (x or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\x01" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def result(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40), min_size=1, max_size=6), st.sampled_from([2, 4, 7]))
def test_index_against_brute_force(pieces, depth):
    text = np.array([v for k, p in enumerate(pieces) for v in [*p.encode(), 256 + k]], np.int64)
    got, seen = passage_dedup.repeated_windows(text, depth), set()
    for i in range(len(text) - depth + 1):
        w = tuple(text[i:i + depth])
        if max(w) < 256:
            assert got[i] == (w in seen)
            seen.add(w)


def test_runs_are_fewer_than_places_in_repetitive_text():
    text = np.concatenate([np.frombuffer((prose(1, 60) + "!").encode(), np.uint8).astype(np.int64) for _ in range(20)] + [np.array([256])])
    samples, _ = passage_dedup.run_index(text, passage_dedup.suffix_order(text))
    assert len(samples) * 8 < len(text)


def test_table(llm, sf, docs):
    assert result(queries.QUERIES["op7_passage_dedup"](llm, sf)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("block", [1 << 22, 2000])
def test_copies_edits_overlaps_and_periods(llm, block, monkeypatch):
    monkeypatch.setattr(passage_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(passage_dedup, "TASK_ANCHORS", 500)
    rng = random.Random(6)
    base, passage = prose(5, 200), prose(88, 30)
    texts = []
    for k in range(40):
        x = list(base if k % 3 else prose(300 + k, 120))
        for _ in range(rng.randint(0, 4)):
            x[rng.randrange(len(x))] = rng.choice("xyzé")
        x = "".join(x)
        at = rng.randrange(len(x))
        texts.append((k, x[:at] + passage[rng.randint(0, 40):] + x[at:] if k % 4 == 0 else x))
    texts += [(100, "a" * 350), (101, "ab" * 170), (102, "a" * 99), (103, "a" * 100), (104, base + base), (105, "é" * 120)]
    frame = llm.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert result(passage_dedup.remove_repeats(frame)) == brute(texts)


def test_edges(llm):
    got = passage_dedup.remove_repeats(edge_docs(llm)).collect()
    assert len(got) == len(edge_rows())
    of = lambda i: [(r.n_bytes, r.n_removed, r.n_spans) for r in got if r.doc_id == i]
    n = len(edge_rows()[0][1])
    assert of(1) == [(n, 0, 0)] and of(5) == [(n, n, 1)] * 2 and of(2) == [(0, 0, 0)] and of(8) == [(n + 5, n, 1)]
    assert of(10)[0][1] == of(10)[0][0] and of(None)[0][1] == 0
    assert passage_dedup.remove_repeats(no_docs(llm)).count() == 0


@pytest.mark.parametrize("parts", [1, 2])
def test_repeated_rows_without_an_earlier_copy_keep_their_text(llm, parts):
    from pyspark.sql import functions as F
    one, other = prose(4, 80), prose(11, 80)
    rows = [(1, one, 0), (1, one, parts - 1), (2, other + one, 0), (2, other + one, parts - 1), (3, other, 0)]
    frame = llm.createDataFrame(rows, "doc_id long, text string, part int").repartitionByRange(parts, F.col("part"))
    assert frame.rdd.getNumPartitions() == parts
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in passage_dedup.remove_repeats(frame).collect())
    want = brute([(1, one), (2, other + one), (3, other)])
    assert got == [(i, *want[i]) for i in (1, 1, 2, 2, 3)] and want[1][1] == 0


def test_no_index_holds_more_than_a_block_of_one_key(llm, monkeypatch):
    monkeypatch.setattr(passage_dedup, "BLOCK_BYTES", 4000)
    line = prose(6, 10)[:72]                      # under a passage long, in every document with neighbours of its own
    texts = [(k, f"{prose(100 + k, 30)} {k % 7} {'same words on both sides ' * (k % 3)}{line}{' and behind it' * (k % 5)} {k} {prose(300 + k, 30)}") for k in range(150)]
    frame = llm.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = passage_dedup._identity(frame)
    claims = passage_dedup.contested(passage_dedup.classified(passage_dedup.occurrences(rows)))
    assert claims.groupBy("key").count().agg({"count": "max"}).first()[0] * 142 > 3 * 4000
    frames = []
    indexed = passage_dedup._indexed_windows
    monkeypatch.setattr(passage_dedup, "_indexed_windows", lambda r, c, *a: frames.append(c) or indexed(r, c, *a))
    assert result(passage_dedup.remove_repeats(frame)) == brute(texts)
    assert all(f.groupBy("key").count().where("count * 142 > 4000").count() == 0 for f in frames) and frames
