import pytest

from cases import edge_docs, no_docs, prose, shingles
from quire.llm import containment, queries


def brute(texts, items, t=0.8):
    out = set()
    sets = [(i, shingles(x)) for i, x in texts]
    for k, y in items:
        s = shingles(y)
        if s:
            out |= {(i, k, len(s), len(s & d)) for i, d in sets if len(s & d) >= t * len(s) - 1e-9}
    return out


def test_table_against_all_pairs(llm, sf):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in queries.QUERIES["op9_containment"](llm, sf).collect()}
    docs = [tuple(r) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in llm.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert got == brute(docs, items) and got


@pytest.mark.parametrize("blocks", [1, 3])
def test_planted_items_of_all_sizes(llm, blocks, monkeypatch):
    items = [(k, prose(50 + k, 8 + 9 * k)) for k in range(14)]
    texts = []
    for k, y in items:
        w = y.split()
        w[len(w) // 2] = "changed"                          # five shingles less
        texts += [(100 + k, f"{prose(k, 300)} {y}\n{prose(k + 1, 500)}"), (200 + k, f"{prose(k, 40)} {' '.join(w)} {prose(k + 2, 900)}"), (300 + k, prose(1000 + k, 700))]
    docs = llm.createDataFrame(texts, "doc_id long, text string")
    frame = llm.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    monkeypatch.setattr(containment, "BLOCK_BYTES", 1 << 20 if blocks == 1 else 2000)
    rows = containment.search(docs, llm.createDataFrame(items, "item_id long, text string")) if blocks == 1 else containment.search(docs, frame)
    assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in rows.collect()} == brute(texts, items)
    kept = {r.doc_id for r in containment.drop_contaminated(docs, frame).collect()}
    assert kept == {i for i, _ in texts} - {r[0] for r in brute(texts, items)}


def test_edges(llm):
    docs = edge_docs(llm)
    items = llm.createDataFrame([(1, None), (2, ""), (3, "one"), (4, prose(1, 30)), (4, prose(1, 30)), (None, prose(9, 40))], "item_id long, text string")
    found = sorted((str(r.doc_id), str(r.item_id)) for r in containment.search(docs, items).collect())
    assert found == sorted([(i, "4") for i in ["1", "5", "5", "8"] * 2] + [("7", "3"), ("None", "None")])
    out = containment.drop_contaminated(docs, items)
    assert out.columns == docs.columns and out.where("doc_id in (1, 5, 7, 8) or doc_id is null").count() == 0 and out.count() == 8
    assert containment.search(no_docs(llm), items).count() == 0
    assert containment.search(docs, items.where("false")).count() == 0
    assert containment.drop_contaminated(docs, items.where("false")).count() == docs.count()
