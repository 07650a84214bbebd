"""Main text of web pages by wrapper induction.

The pages of a host are made from few templates.  Pages of a host whose blocks
near the root are alike form a layout, and one page with text of each layout is
its reference; every other page's block tree is aligned with it by simple tree
matching, where runs of like siblings count as one repeated node.  Aligned texts
that are equal vote for "constant", others for "varying"; votes are summed per
layout and reference node.  Constant texts are the template, the varying slots
are content.  A page's main text is what its own alignment leaves inside the
article.

The article is the element that says so, unless another that is named as
content holds more than twice its text; a page without either is taken whole.
Elements whose kind or role excludes them (navigation, asides, forms), adverts
and reader comments go.  Other names are only a hint: an element that is named
like a notice, a share bar or a sidebar goes unless it reads as prose, that is
has ``PROSE_WORDS`` words of which links are a small share; paragraphs, headings
and lists are never judged by their names, an article's own header neither.

A copy of the reference says nothing about its template, so a page whose
article is the reference's does not vote; a layout with one page has no
template.  Votes are summed inside tasks before they are shuffled, and the
wrapper of a layout (one page and its constant texts) travels to the pages: by
broadcast within a byte bound, where a page is parsed once for its layout and
what it is compared for, else by a join on (layout, salt), so a host that holds
a large part of all pages is spread.

Defined results: null or empty html gives an empty text; a null url or one
without a host has no template; repeated rows are answered each; other columns
are ignored (their names cannot clash); an empty table gives no row.
"""
from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunked, materialize, small
from .htmltree import ADVERTS, Node, parse

SCHEMA = "page_id long, url string, text string, n_chars long"
BROADCAST_BYTES = 16 << 20
SALTS = 32
COPY_SHARE = 0.5          # of the reference's article: beyond it a page is a copy
WHOLE_SHARE = 0.95        # the same where no element is the article
LAYOUT_DEPTH = 3          # of the blocks that tell a layout
PROSE_WORDS, LINK_SHARE = 40, 0.3
ARTICLE_SHARE = 0.5       # of the text of another content element that an article has at least
CONSTANT_SHARE = 0.5      # of the votes
LEAST_VOTES = 2
DEPTH = 60                # of slots; what lies deeper belongs to its ancestor there

# --- fixed values: what is not the article ---
NOT_ARTICLE = {"head", "nav", "footer", "aside", "form", "fieldset", "button", "select", "dialog", "menu", "svg", "object", "audio", "video", "canvas", "search", "option"}
NOT_ARTICLE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar", "status"}
NOT_ARTICLE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "skip",
    "header", "masthead", "topbar", "footer", "copyright", "sidebar", "aside", "widget", "related", "recommended", "trending",
    "comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "reactions",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall",
    "signup", "login", "form", "search", "share", "sharing", "social", "hidden", "print", "taboola", "outbrain",
}
ARTICLE_NAMES = {"article", "content", "post", "entry", "story", "main", "body"}


#: Decisive wherever they stand: adverts and reader comments.
COMMENT_NAMES = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "reactions"}
#: Words beside which a name tells of the page, not of the element ("with-sidebar").
ABOUT_PAGE = {"with", "has", "no", "without"}
#: Elements that are never judged by their names.
TEXT_TAGS = {"article", "main", "body", "html", "h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption"}


def _prose(n: Node) -> bool:
    """Does an element read as prose: enough words, few of them links?"""
    words = letters = links = 0
    stack = [n]
    while stack:
        k = stack.pop()
        links += k.links
        for c in k.content:
            if isinstance(c, str):
                words += c.count(" ") + 1
                letters += len(c)
            else:
                stack.append(c)
    return words >= PROSE_WORDS and links <= LINK_SHARE * letters


def _outside(n: Node, in_article: bool) -> bool:
    if n.tag in NOT_ARTICLE or n.role in NOT_ARTICLE_ROLES or n.hidden or n.tag == "header" and not in_article:
        return True
    if not n.names:
        return False
    names = set(n.names)
    if n.tag in TEXT_TAGS:
        return n.tag == "article" and bool({"comment", "reply"} & names)
    if names.isdisjoint(NOT_ARTICLE_NAMES):
        return False
    if not names.isdisjoint(COMMENT_NAMES) or not names.isdisjoint(ADVERTS):
        return True
    hints = NOT_ARTICLE_NAMES & names
    if in_article:
        hints -= {"header"}
    if not hints or ABOUT_PAGE & names and ARTICLE_NAMES & names:
        return False
    return not _prose(n)


def _kind(n: Node) -> int:
    """How clearly an element says that it is the article: 0 most, 3 not at all."""
    if n.tag == "article":
        return 0
    if n.tag == "main" or n.role == "main":
        return 1
    return 2 if n.names and n.tag in ("div", "section") and not ARTICLE_NAMES.isdisjoint(n.names) else 3


def _roots(root: Node) -> list[list[Node]]:
    """For each kind the topmost nodes of it, in page order, outside of what is
    not the article."""
    out: list[list[Node]] = [[], [], []]
    stack = [(root, 0)]
    while stack:
        n, within = stack.pop()
        if n is not root and _outside(n, False):
            continue
        kind = _kind(n)
        if kind < 3 and not within >> kind & 1:
            out[kind].append(n)
            within |= 1 << kind
        stack += [(kid, within) for kid in reversed(n.nodes())]
    return out


def _letters(nodes: list[Node]) -> int:
    """Letters of the text that stays of the given roots."""
    total = 0
    for top in nodes:
        stack = [top]
        while stack:
            n = stack.pop()
            if n is top or not _outside(n, True):
                total += sum(map(len, n.texts()))
                stack += n.nodes()
    return total


def article_roots(root: Node) -> list[Node]:
    """The elements that hold the article, by the clearest sign that holds a
    fair share of the text; the whole page without one."""
    kinds = _roots(root)
    if not any(kinds):
        return [root]
    if sum(map(bool, kinds)) == 1:
        return next(found for found in kinds if found)
    size = [_letters(found) for found in kinds]
    return next(found for found, n in zip(kinds, size) if found and n >= ARTICLE_SHARE * max(size))


class Slot:
    """A node of the reduced tree: like leaf siblings in a row are one slot."""
    __slots__ = ("label", "items", "kids", "index")

    def __init__(self, label: str):
        self.label, self.items, self.kids, self.index = label, [], [], -1


def reduced(root: Node) -> list[Slot]:
    """The slots of a page in page order (the first is the root); a slot's
    ``items`` are (text, node) pairs."""
    order: list[Slot] = []

    def build(n: Node) -> Slot:
        top = Slot(n.label)
        work = [(n, top, 0)]
        while work:
            node, slot, depth = work.pop()
            slot.items += [(t, node) for t in node.texts()]
            if depth == DEPTH:
                work += [(kid, slot, DEPTH) for kid in reversed(node.nodes())]
                continue
            for kid in node.nodes():
                leaf = not kid.nodes()
                last = slot.kids[-1] if slot.kids else None
                if leaf and last is not None and last.label == kid.label and not last.kids:
                    last.items += [(t, kid) for t in kid.texts()]
                    continue
                s = Slot(kid.label)
                slot.kids.append(s)
                work.append((kid, s, depth + 1))
        return top
    first = build(root)
    stack = [first]
    while stack:
        s = stack.pop()
        s.index = len(order)
        order.append(s)
        stack += reversed(s.kids)
    return order


def tree_match(a: Slot, b: Slot) -> list[tuple[Slot, Slot]]:
    """Simple tree matching: a largest set of aligned (a, b) nodes that keeps
    labels, order and ancestry."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def weigh(x: Slot, y: Slot) -> int:
        if x.label != y.label:
            return 0
        key = (x.index, y.index)
        if key in memo:
            return memo[key][0]
        xs, ys = x.kids, y.kids
        lo, hx, hy = 0, len(xs), len(ys)
        fixed = []
        while lo < min(hx, hy) and xs[lo].label == ys[lo].label:
            fixed.append((xs[lo], ys[lo]))
            lo += 1
        while hx > lo and hy > lo and xs[hx - 1].label == ys[hy - 1].label:
            hx, hy = hx - 1, hy - 1
            fixed.append((xs[hx], ys[hy]))
        total = 1 + sum(weigh(p, q) for p, q in fixed)
        p, q = xs[lo:hx], ys[lo:hy]
        if p and q:
            w = [[weigh(i, j) for j in q] for i in p]
            best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
            for i in range(len(p)):
                for j in range(len(q)):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[i][j])
            total += best[-1][-1]
            i, j = len(p), len(q)
            while i and j:
                if w[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + w[i - 1][j - 1]:
                    fixed.append((p[i - 1], q[j - 1]))
                    i, j = i - 1, j - 1
                elif best[i][j] == best[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
        memo[key] = (total, fixed)
        return total

    if not weigh(a, b):
        return []
    out, stack = [], [(a, b)]
    while stack:
        x, y = stack.pop()
        out.append((x, y))
        stack += memo[(x.index, y.index)][1]
    return out


def _mark(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Reference:
    """A layout's reference page: its slots, and the marks and size of its article's texts."""

    def __init__(self, page: str):
        root = parse(page)
        self.slots = reduced(root)
        self.size = {_mark(t): len(t) for s in self.slots for t, _ in s.items}
        tops = article_roots(root)
        self.whole = tops == [root]
        self.article: set[int] = set()
        stack = list(tops)
        while stack:
            n = stack.pop()
            self.article |= {_mark(t) for t in n.texts()}
            stack += n.nodes()


def votes(reference: Reference, page: list[Slot]) -> list[tuple[int, int, bool]]:
    """(slot, text mark, constant) of the reference's texts against one page;
    none where the page's article is the reference's."""
    out = []
    for x, y in tree_match(reference.slots[0], page[0]):
        here = {t for t, _ in y.items}
        out += [(x.index, _mark(t), t in here) for t in dict.fromkeys(t for t, _ in x.items)]
    whole = sum(reference.size[m] for m in reference.article)
    same = sum(reference.size[m] for m in {m for _, m, c in out if c and m in reference.article})
    return [] if same > (WHOLE_SHARE if reference.whole else COPY_SHARE) * whole else out


def layout(root: Node) -> str:
    """What a page's blocks near the root are, whatever their number; empty for
    a page without text."""
    labels, some = set(), False
    stack = [(root, 0)]
    while stack:
        n, depth = stack.pop()
        some = some or bool(n.texts())
        if depth <= LAYOUT_DEPTH:
            labels.add(f"{depth}{n.label}")
        stack += [(kid, depth + 1) for kid in n.nodes()]
    return hashlib.blake2b("\n".join(sorted(labels)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest() if some else ""


def main_text(page: str | None, reference: Reference | None = None, template: set[tuple[int, int]] = frozenset()) -> str:
    """A page's main text: article blocks that are not the host's template."""
    return tree_text(parse(page), reference, template)


def tree_text(root: Node, reference: Reference | None, template: set[tuple[int, int]]) -> str:
    """``main_text`` of a page that is parsed already."""
    gone: set[tuple[int, str]] = set()
    if reference and template:
        for x, y in tree_match(reference.slots[0], reduced(root)[0]):
            gone |= {(id(n), t) for t, n in y.items if (x.index, _mark(t)) in template}
    blocks: list[str] = []
    for top in article_roots(root):
        inside = top is not root
        stack: list[Node | str | tuple] = [top]
        while stack:
            n = stack.pop()
            if isinstance(n, tuple):
                if n not in gone:
                    blocks.append(n[1])
            elif n is top or not _outside(n, inside):
                stack += [c if not isinstance(c, str) else (id(n), c) for c in reversed(n.content)]
    return "\n\n".join(blocks)


def host(url: Column) -> Column:
    """The host of a URL in lower case, empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _held(wrappers: DataFrame) -> Broadcast | None:
    """``wrappers`` (materialised, one row a host and layout) as a broadcast table,
    if it is within the bound: host -> (reference, template, seed)."""
    size = wrappers.agg(F.sum(F.octet_length("reference") + F.lit(16) * F.coalesce(F.size("template"), F.lit(0)))).first()[0] or 0
    if size > BROADCAST_BYTES:
        return None
    held = {r["host"]: (r["reference"], {tuple(t) for t in r["template"]}, r["seed"]) for r in wrappers.collect()}
    return wrappers.sparkSession.sparkContext.broadcast(held)


def _with_wrapper(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Each page, by host and layout, beside its columns of ``wrappers`` that are
    beyond the bound of a broadcast: pages of a host are spread by a salt."""
    salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return with_layout(pages).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left").drop("salt")


def _beside(pages: DataFrame, wrappers: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over each page (page_id, url, host, html) and its wrapper: its
    batches hold (row, tree, key, reference, template, seed), None and empty where
    there is none.  A page is parsed once where the wrappers are broadcast."""
    held = _held(wrappers)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for part in chunked(batches, "html" if held else ["html", "reference"]):
                yield part, rows(part)

        def rows(part):
            for row in part.to_pylist():
                tree = parse(row["html"])
                if held:
                    key = layout_key(row["host"], tree)
                    yield (row, tree, key, *held.value.get(key, (None, set(), None)))
                else:
                    yield row, tree, row["host"], row["reference"], {(t["slot"], t["mark"]) for t in row["template"] or ()}, row["seed"]
        return run(parts())
    names = ["page_id", "url", "host", "html"]
    rows = pages.select(*names) if held else _with_wrapper(pages, wrappers).select(*names, "reference", "template", "seed")
    return rows.mapInArrow(read, schema)


class _References:
    """Parsed references of the hosts that a task met last."""

    def __init__(self, keep: int = 64):
        self.keep, self.held = keep, OrderedDict()

    def get(self, name: str, page: str) -> Reference:
        if name not in self.held:
            self.held[name] = Reference(page)
            if len(self.held) > self.keep:
                self.held.popitem(last=False)
        self.held.move_to_end(name)
        return self.held[name]


def layout_key(name: str, root: Node | None) -> str:
    """The key of a page's host and layout, '' for pages without a host or without text."""
    kind = layout(root) if name else ""
    return f"{name} {kind}" if kind else ""


def with_layout(rows: DataFrame) -> DataFrame:
    """(page_id, url, host, html) -> the same with ``host`` made the key of host
    and layout, '' for pages without a host or without text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "html"):
            keys = []
            for name, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                keys.append(layout_key(name, parse(page) if name else None))
            yield pa.RecordBatch.from_arrays([part.column(c).combine_chunks() if c != "host" else pa.array(keys, pa.string()) for c in part.column_names], names=part.column_names)
    return rows.mapInArrow(run, rows.schema)


def induce(rows: DataFrame) -> DataFrame:
    """rows (page_id, url, host, html) -> by host and layout (host, reference,
    template, seed): the reference page and the (slot, mark) pairs of its constant texts."""
    first = materialize(with_layout(rows).where("host <> '' and html is not null").groupBy("host").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "page_id"))
    # Pages that are nobody's first are not parsed for it.
    some = with_layout(rows.where("html is not null").join(small(first.select("page_id").distinct()), "page_id", "left_semi"))
    seeds = materialize(some.join(small(first), ["host", "page_id"]).groupBy("host").agg(F.min("html").alias("reference"), F.first("page_id").alias("seed"))
                        .withColumn("template", F.expr("cast(array() as array<struct<slot: int, mark: long>>)")))

    def run(parts) -> Iterator[pa.RecordBatch]:
        refs, count = _References(), {}

        def out():
            rows = [(*k, c, t) for k, (c, t) in count.items()]
            count.clear()
            cols = zip(*rows)
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "slot", "mark", "constant", "votes"])
        for _, pages in parts:
            for row, tree, name, ref, _, seed in pages:
                if ref is None or row["page_id"] is None or row["page_id"] == seed:
                    continue
                for slot, mark, same in votes(refs.get(name, ref), reduced(tree)):
                    c, t = count.get((name, slot, mark), (0, 0))
                    count[(name, slot, mark)] = (c + same, t + 1)
            if len(count) > 200_000:
                yield out()
        if count:
            yield out()
    counted = _beside(rows.where("html is not null"), seeds, run, "host string, slot int, mark long, constant long, votes long")
    constant = (counted.groupBy("host", "slot", "mark").agg(F.sum("constant").alias("c"), F.sum("votes").alias("v"))
                .where((F.col("v") >= LEAST_VOTES) & (F.col("c") > CONSTANT_SHARE * F.col("v"))))
    templates = constant.groupBy("host").agg(F.collect_list(F.struct("slot", "mark")).alias("template"))   # at most the reference's texts
    return materialize(seeds.select("host", "reference", "seed").join(templates, "host"))


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> (page_id, url, text, n_chars)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))

    def run(parts) -> Iterator[pa.RecordBatch]:
        refs = _References()
        for part, pages in parts:
            texts = [tree_text(tree, refs.get(name, ref) if template else None, template) for _, tree, name, ref, template, _ in pages]
            yield pa.RecordBatch.from_arrays([part.column("page_id").combine_chunks(), part.column("url").combine_chunks(), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return _beside(rows, induce(rows), run, SCHEMA)
