"""What the vectorised helpers hold is bounded by the chunk, not by what a worker met before."""
import tracemalloc

import pyarrow as pa
import pytest

from cases import prose
from quire.llm import bytewords as bw
from quire.llm import ngram_join, quality, spotsigs
from quire.llm.common import CHUNK_BYTES, chunked


def batches(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])


@pytest.mark.parametrize("work", [
    lambda col: spotsigs.signatures(*bw.text_bytes(col)),
    lambda col: quality.features(*bw.text_bytes(col)),
    lambda col: bw.distinct_sorted(*bw.shingles(*reversed(bw.words(*bw.text_bytes(col))[2:]))),
], ids=["spotsigs", "quality", "shingles"])
def test_a_chunk_s_memory(work):
    text = prose(1, 5000)
    source = [batches([text] * 20) for _ in range(10)]            # some 8 MB in all
    work(pa.array(["a word"]))
    tracemalloc.start()
    for part in chunked(source, "text"):
        work(part.column("text"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 140 * CHUNK_BYTES


def test_powers_are_kept_up_to_a_bound():
    long_one, _ = bw._powers(3 * bw.KEPT_POWERS)
    assert len(long_one) == 3 * bw.KEPT_POWERS + 1
    assert len(bw._pow) <= bw.KEPT_POWERS + 1 and len(bw._inv) == len(bw._pow)
    short, inverse = bw._powers(1000)
    assert (short[:1001] == long_one[:1001]).all() and short[7] * inverse[7] == 1


def test_chunks_are_cut_by_bytes():
    parts = list(chunked([batches(["x" * 1000] * 5000)], "text"))
    assert max(sum(map(len, p.column("text").to_pylist())) for p in parts) <= CHUNK_BYTES + 1000 and sum(p.num_rows for p in parts) == 5000
