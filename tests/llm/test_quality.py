import zlib

import numpy as np

from cases import edge_docs, edge_rows, no_docs
from quire.llm import quality, queries


def test_held_out_accuracy(llm):
    d = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op1_quality"](llm, d).collect()
    truth = {r.doc_id: r.quality for r in llm.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(rows) == llm.read.parquet(f"{d}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.predicted for r in held if truth[r.doc_id] == 1) >= 0.97 * sum(truth[r.doc_id] for r in held)


def test_edges(llm, docs):
    labels = llm.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 1), (6, 1), (3, 0)], "doc_id long, quality int")
    feats = quality.with_features
    model = quality.train(feats(edge_docs(llm)), labels)
    got = quality.score(feats(edge_docs(llm)), model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(feats(no_docs(llm)), model).count() == 0
    none = quality.train(feats(no_docs(llm)), labels)
    assert {r.score for r in quality.score(feats(edge_docs(llm)), none).collect()} == {0.5}
    one = quality.train(feats(docs), llm.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int"))
    scores = [r.score for r in quality.score(feats(docs), one).collect()]
    assert sum(s > 0.5 for s in scores) > 0.8 * len(scores)
    kept = quality.keep_good(edge_docs(llm), none)
    assert kept.columns == edge_docs(llm).columns and kept.count() == len(edge_rows())


def test_equal_texts_equal_scores_and_labels_stay_out(llm, docs):
    labels = llm.read.parquet("/root/testdata/sf0.001/labels.parquet")
    feats = quality.with_features
    model = quality.train(feats(docs), labels)
    moved = docs.selectExpr("doc_id + 1000000 as doc_id", "text")
    a = {r.doc_id: r.score for r in quality.score(feats(docs), model).collect()}
    b = {r.doc_id - 1000000: r.score for r in quality.score(feats(moved), model).collect()}
    assert a == b


def test_scores_are_those_of_a_plain_discriminant(llm):
    """A dense quadratic discriminant of one machine: covariances by numpy,
    inverses and determinants instead of Cholesky factors."""
    d = "/root/testdata/sf0.01"
    docs, labels = (llm.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    feats = quality.with_features(docs)
    rows = {r.doc_id: np.array(r.x) for r in feats.collect()}
    y = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5}
    x = {c: np.array([rows[i] for i, q in y.items() if q == c and i in rows]) for c in (0, 1)}
    k = len(quality.FEATURES)
    n = sum(map(len, x.values()))
    own = {c: np.cov(x[c].T, bias=True) for c in x}
    pooled = sum(len(x[c]) * own[c] for c in x) / n
    pooled = (1 - quality.BETA) * pooled + quality.BETA * np.diag(np.diag(pooled)) + quality.RIDGE * np.eye(k)
    density = {}
    for c in x:
        a = max(quality.ALPHA, min(1.0, k / len(x[c])))
        cov = (1 - a) * own[c] + a * pooled + quality.RIDGE * np.eye(k)
        z = np.array(list(rows.values())) - x[c].mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)
        density[c] = np.log((len(x[c]) + 1) / (n + 2)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance
    want = dict(zip(rows, 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))))
    got = {r.doc_id: r.score for r in quality.score(feats, quality.train(feats, labels)).collect()}
    assert set(got) == set(want) and max(abs(got[i] - want[i]) for i in want) < 1e-6
