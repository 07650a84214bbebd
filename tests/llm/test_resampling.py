import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import edge_docs, edge_rows, no_docs
from quire.llm import queries, resampling

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, low=1, high=1):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def brute(texts, target, percent=10, least=20, low=1, high=1):
    """Counter of (doc_id, n_features, weight, score, rank) over all rows."""
    feats = [[c % 10000 for c in runs(x, low, high)] for _, x in texts]
    s, t = Counter(b for f in feats for b in f), Counter(c % 10000 for x in target for c in runs(x, low, high))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for (i, x), f in zip(texts, feats):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(runs(x)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    out = Counter((*r[:4], k + 1) for k, r in enumerate(able[:percent * len(able) // 100]))
    return out + Counter((*r[:4], None) for r in able[percent * len(able) // 100:]) + Counter((*r[:4], None) for r in rows if not r[4])


def got(rows):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)


def test_table(llm, sf, docs):
    target = [r[0] for r in llm.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], target)
    rows = queries.QUERIES["op13_resampling"](llm, sf)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"}
    assert got(rows.collect()) == want


def test_edges(llm):
    target = llm.createDataFrame([(1, edge_rows()[0][1]), (2, None), (3, "")], "item_id long, text string")
    for percent in (10, 50, 100):
        rows = resampling.resample(edge_docs(llm), target, percent=percent)
        assert got(rows.collect()) == brute(edge_rows(), [edge_rows()[0][1]], percent)
    assert got(resampling.resample(edge_docs(llm), target.where("false"), percent=50).collect()) == brute(edge_rows(), [], 50)
    assert resampling.resample(no_docs(llm), target).count() == 0


def test_longer_runs(llm):
    target = llm.createDataFrame([(1, edge_rows()[0][1])], "item_id long, text string")
    rows = resampling.resample(edge_docs(llm), target, min_n=1, max_n=3, percent=50)
    assert got(rows.collect()) == brute(edge_rows(), [edge_rows()[0][1]], 50, low=1, high=3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(st.sampled_from("aAz09 .\x00éß好_-"), max_size=30), max_size=4), max_size=5), st.integers(1, 3))
def test_automaton_gives_the_same(chunks, high):
    features = resampling.Features(10000, 1, high)
    for texts in chunks + chunks:
        bucket, owner, words = features(pa.array(texts, pa.string()))
        for i, x in enumerate(texts):
            assert sorted(bucket[owner == i].tolist()) == sorted(c % 10000 for c in runs(x, 1, high)) and words[i] == len(runs(x))
        features.scanner.waiting |= {w: 2 for w in list(features.scanner.waiting)[::2]}
        features.scanner.limit = 5
        keep, resampling.WAITING = resampling.WAITING, 1        # learn at once
        features.scanner._learn()
        resampling.WAITING = keep


def test_crc_of_joined_strings():
    crc = resampling.Crc()
    parts = [b"", b"a", b"hello wor", b"ld, there" * 50, bytes(range(256)) * 40]
    for a in parts:
        for b in parts:
            assert crc.join(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))[0] == zlib.crc32(a + b)
