import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import edge_docs, edge_rows, no_docs
from quire.llm import queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = token_counts.PrefixTokens(PATH)
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("abcsdtrevlm'’ \n\t.,;!012ÀéßÿÖ×÷¿ªµ½—“<|>İœ한각́"), st.characters(codec="utf-8")), max_size=30)
PARTS = st.lists(st.one_of(TEXTS, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "internationalization", "they'll", "you've ", "!", "'"])), max_size=5)


def size(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def normalised(text):
    out, end = [], 0
    for m in OURS.special.finditer(text):
        out += [LIBRARY.normalizer.normalize_str(text[end:m.start()]), m.group()]
        end = m.end()
    return "".join([*out, LIBRARY.normalizer.normalize_str(text[end:])])


@settings(max_examples=200, deadline=None)
@given(PARTS)
def test_every_prefix_is_the_library_s(parts):
    text = "".join(parts)
    z, got = normalised(text), token_counts.counts(OURS.steps(text)).tolist()
    assert got == [size(z[:i]) for i in range(len(z) + 1)]
    assert got[-1] == size(text)


def test_long_pieces():
    for text in ("x" * 5000 + "yz", "好的" * 3000, "!?" * 4000, "a1" * 3000):
        got = token_counts.counts(OURS.steps(text))
        assert got[-1] == size(text) and all(got[i] == size(text[:i]) for i in range(0, len(text), 997))


def test_store_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_UNITS", 3)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 5)
    ours = token_counts.PrefixTokens(PATH)
    text = "the internationalization, of a stone's wintergardens; the stone's unhurried, of the wintergardens"
    assert token_counts.counts(ours.steps(text)).tolist() == [size(text[:i]) for i in range(len(text) + 1)]


def check(rows, texts, limit):
    want = sorted((i if i is not None else -1, len((x or "").encode()), size(x or "")) for i, x in texts)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > limit) for r in rows)


def test_table(llm, sf, docs):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = queries.QUERIES["op11_token_counts"](llm, sf).collect()
    check(rows, texts, 2048)
    by_id = dict(texts)
    for r in rows:
        z = LIBRARY.normalizer.normalize_str(by_id[r.doc_id] or "")
        assert (r.fit_chars == len(z)) if not r.over_limit else size(z[:r.fit_chars]) <= 2048 < size(z[:r.fit_chars + 1])


def test_edges(llm):
    table = token_counts.prefix_table(edge_docs(llm))
    check(token_counts.answers(table, 20).collect(), edge_rows(), 20)
    assert token_counts.answers(token_counts.prefix_table(no_docs(llm))).count() == 0
    at = token_counts.tokens_at(table.where("doc_id = 8").withColumn("position", F.explode(F.array(*map(F.lit, [0, 5, 30, 10**7])))))
    text = dict(edge_rows())[8]
    assert {r.position: r.n_tokens for r in at.collect()} == {p: size(text[:p]) for p in (0, 5, 30, 10**7)}
