import random

import pytest

from cases import Groups, edge_docs, no_docs, prose, shingles
from quire.llm import components, ngram_join, queries


def brute(texts):
    sets = {i: shingles(x) for i, x in texts}
    groups = Groups(sorted(sets))
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            s, t = sets[i], sets[j]
            if s and t and 5 * min(len(s), len(t)) >= 4 * max(len(s), len(t)) and 100 * len(s & t) >= 80 * len(s | t):
                groups.link(i, j)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_table(llm, sf, docs):
    assert result(queries.QUERIES["op5_ngram_join"](llm, sf)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_families_chains_and_shared_passages(llm, seed):
    rng = random.Random(seed)
    passage, texts = prose(77, 60), []
    base = prose(5, 100).split()
    for k in range(60):                                    # near copies with own edits, chains among them
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 30)}"
        texts.append((k, " ".join(w)))
    texts += [(100 + k, prose(200 + k, rng.randint(1, 30)) + " " + passage) for k in range(60)]
    for k in range(20):                                    # a chain: each links to the next
        texts.append((300 + k, " ".join(prose(9, 200).split()[3 * k:3 * k + 60])))
    texts += [(400 + k, x) for k, x in enumerate(["a b", "A  b", "a b c", "a b c d e", "a b c d e f", "", "  "])]
    frame = llm.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert result(ngram_join.jaccard_groups(frame)) == brute(texts)
    kept = {r.doc_id for r in ngram_join.keep_one(frame).collect()}
    assert kept == {i for i, (_, c) in brute(texts).items() if i == c}


def test_edges(llm):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(edge_docs(llm)).collect()), key=str)
    assert [r for r in rows if r[0] == 5] == [(5, len(shingles(prose(1, 120))), 1)] * 2
    assert (8, len(shingles(prose(1, 120) + " tail")), 1) in rows and (2, 0, 2) in rows and (4, 0, 4) in rows and (None, 36, None) in rows and (10, len(shingles(prose(3, 9000))), 6) in rows
    kept = ngram_join.keep_one(edge_docs(llm))
    assert kept.columns == edge_docs(llm).columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, None, 6, 7, 9, 11, 12}
    assert ngram_join.jaccard_groups(no_docs(llm)).count() == 0 and ngram_join.keep_one(no_docs(llm)).count() == 0


def test_components_of_random_graphs(llm):
    rng = random.Random(4)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(k, k + 1) for k in range(200, 260)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.link(a, b)
    got = {r.node: r.component for r in components.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for x in groups.up if any(x in e and e[0] != e[1] for e in edges)}


def test_one_row_of_each_group_stays(llm):
    base, other, third = prose(1, 120), prose(2, 120), prose(9, 90)
    near = lambda x, k: f"{x} tail{k}"
    rows = [(1, base), (1, base), (1, base), (2, near(base, 2)),            # the smallest row doubled
            (None, near(base, 3)), (None, base),                           # copies without an id
            (None, third), (None, near(third, 1)), (None, near(third, 1)),     # a group without any id
            (7, near(base, 7)), (7, other), (8, near(other, 1)), (9, ""), (9, ""), (None, None)]
    frame = llm.createDataFrame([(i, x, "z") for i, x in rows], "doc_id long, text string, __keep string").repartition(4)
    out = ngram_join.keep_one(frame)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert out.columns == frame.columns
    assert [r for r in got if r[0] is not None] == [(1, base), (7, other), (9, ""), (9, "")]
    none = [x for i, x in got if i is None]
    assert len(none) == 2 and None in none and set(none) - {None} <= {third, near(third, 1)}
