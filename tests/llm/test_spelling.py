import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from cases import edge_docs, edge_rows, no_docs
from quire.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def word_counts(texts, shortest=6, slip=199):
    out = Counter()
    for i, x in texts:
        for w in RUN.findall(x or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= shortest:
                out[w] += 1
    return out


def edits(a, b):
    """The plain edit distance, up to 2."""
    if abs(len(a) - len(b)) > 1:
        return 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1, *row]
        for j, y in enumerate(b):
            row[j + 1] = min(row[j + 1] + (x != y), row[j + 2] + 1, row[j] + 1)
        row.pop()
    return min(row[-1], 2)


def by_hole(words):
    """All pairs at distance one, by the words with one letter left out or masked."""
    holes, out = {}, {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((len(w), w[:k] + "\0" + w[k + 1:]), []).append(w)
    for same in holes.values():
        for a in same:
            out[a] |= {b for b in same if b != a}
    for w in words:
        for k in range(len(w)):
            s = w[:k] + w[k + 1:]
            if s in out:
                out[w].add(s)
                out[s].add(w)
    return out


def brute(texts, shortest=6, least=5, ratio=5, slip=199):
    n = {w: k for w, k in word_counts(texts, shortest, slip).items() if k >= least}
    near = by_hole(n)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def got(rows):
    rows = rows.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_table(llm, sf, docs):
    rows = queries.QUERIES["op12_spelling"](llm, sf)
    assert dict(rows.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert got(rows) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_larger_table(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], least=2, ratio=2, slip=7)
    assert got(spelling.variants(docs, min_count=2, ratio=2, slip=7, block=3)) == want
    assert any(root != form for _, form, root, *_ in want if form)      # chains of forms are there


def test_edges(llm):
    long_word = "ab" * 40000
    rows = edge_rows() + [(20, f"{long_word} {long_word}x schöne Schöne SCHÖNE schone"), (21, f"{long_word}x {long_word} ßüßüßü ÀÉÎÕÜÿ×÷")]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least, ratio, block in ((1, 1, 20_000), (2, 2, 2)):
        # One's own count at least: ties between near words of equal count have no form above ratio 1.
        if ratio > 1:
            assert got(spelling.variants(docs, 4, least, ratio, block=block)) == brute(rows, 4, least, ratio)
    assert got(spelling.variants(edge_docs(llm), 4, 1, 3)) == brute(edge_rows(), 4, 1, 3)
    assert spelling.variants(no_docs(llm)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abeéß", min_size=1, max_size=6), min_size=2, max_size=12, unique=True))
def test_search_finds_each_pair_once(words):
    found = Counter()
    trees = {}
    for w in words:
        counts = tuple(spelling.vector(w))
        trees.setdefault(counts[:spelling.TOP], spelling.Subtree()).add(counts, w, 1)
    for w in words:
        counts = spelling.vector(w)
        for spent, head in spelling.routes(counts):
            if tuple(head) in trees:
                found.update(frozenset((w, o)) for o, _ in trees[tuple(head)].near(tuple(counts), w, spent))
    want = {frozenset((a, b)) for a in words for b in words if edits(a, b) == 1}
    assert set(found) == want and set(found.values()) <= {1}
