import math
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from cases import edge_docs, edge_rows, no_docs
from quire.llm import queries, sharding


def check(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    known = defaultdict(set)
    for i, x in texts:
        raw = (x or "").encode()
        known[i].add((len(raw) + 8, zlib.crc32(raw)))
    slots = defaultdict(list)
    for r in rows:
        assert (r["size"], r.text_crc32) in known[r.doc_id] and r.law == "key"
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = defaultdict(set)
    for r in rows:
        by_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(s) == 1 for s in by_key.values())


def test_table(llm, sf, docs):
    rows = queries.QUERIES["op8_sharding"](llm, sf).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    again = sharding.shard(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_edges(llm):
    check(sharding.shard(edge_docs(llm)).collect(), edge_rows())
    assert sharding.shard(no_docs(llm)).count() == 0


def test_weights_and_growth(llm):
    keys = llm.range(20000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    rows = sharding.shard(keys, weights=[1.0, 2.0, 1.0]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 20000 for r in rows}
    assert abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    moved = sharding.shard(keys).where("shard <> grown_shard")
    assert moved.where("grown_shard <> 24").count() == 0 and abs(moved.count() / 20000 - 1 / 25) < 0.01
    assert sharding.shard(keys, weights=[1.0]).select("shard").distinct().collect()[0][0] == 0


def hashed(name, *numbers):
    """The engine's hash of a text and then of numbers (int or long), each seeded by the last."""
    h = xxhash.xxh64(name.encode(), seed=42).intdigest()
    for value, size in numbers:
        h = xxhash.xxh64(value.to_bytes(size, "little", signed=True), seed=h).intdigest()
    return h


def test_each_key_goes_to_its_highest_score(llm):
    """The argmax of rendezvous hashing, computed again key by key."""
    for weights in ([1.0] * 24, [1.0, 2.5, 0.5]):
        rows = sharding.shard(llm.range(300).select(F.col("id").alias("doc_id"), F.lit("").alias("text")), weights=weights).collect()
        for r in rows:
            def score(k, w):
                u = ((hashed("shard", (k, 4), (r.doc_id, 8)) >> 11) + 0.5) / (1 << 53)
                return -w / math.log(u), -k
            best = [-max(score(k, w) for k, w in enumerate(ws))[1] for ws in (weights, [*weights, 1.0])]
            assert [r.shard, r.grown_shard] == best
