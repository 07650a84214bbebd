from cases import CLASH, edge_docs, no_docs, shingles
import test_containment
import test_ngram_join
import test_packing
import corpus_pipeline
from quire.llm import queries


def test_every_operator_has_one_query():
    names = [n for n in queries.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_stages_on_their_own_input(llm, sf, tmp_path):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    schema, texts = docs.schema, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        stage(llm, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = llm.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.schema == schema
            texts = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{sf}/labels.parquet").collect()}
            good = [i for i, _ in before if labels.get(i) == 1]
            assert sum(i in texts for i in good) >= 0.97 * len(good)
            assert sum(i in texts for i, _ in before if labels.get(i) == 0) <= 0.1 * len(before)
        elif name == "line_dedup":
            assert set(texts) == {i for i, _ in before}
        elif name == "near_copies":
            assert set(texts) == {i for i, (_, c) in test_ngram_join.brute(before).items() if i == c}
        elif name == "decontamination":
            items = [tuple(r) for r in llm.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(texts) == {i for i, _ in before} - {r[0] for r in test_containment.brute(before, items)}
        else:
            test_packing.check(docs.collect(), before)


def test_run_equals_the_stages(llm, sf):
    rows = queries.QUERIES["pipeline"](llm, sf)
    assert rows.count() > 0 and rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_stages_take_odd_and_empty_tables(llm, sf):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (edge_docs(llm), no_docs(llm)):
            out = stage(llm, frame, sf)
            rows = out.collect()
            assert name == "packing" or out.columns == frame.columns
            assert bool(rows) == (frame.count() > 0)
