"""Listing pages: implied end tags, numbering, cut-off, subjects."""
import pyarrow as pa

from quire.session import apply_confs
from quire.sources import listing

PAGE = """<!DOCTYPE html><html><body><div id='dlpage'><h1>New papers</h1>
<ul><li><a href="#item0">New</a><li><a href=#item3>Cross lists</a> <a href="#item1">x</a><li><a href="/help">Help</a></ul>
<dl>
<dt><a name='item1'>[1]</a> <a href="/abs/2601.00001" title="Abstract">p1</a> [<a href="/pdf/2601.00001" title="Download PDF">pdf</a>]
<dd><div class='meta'><div class='list-title'><span class='descriptor'>Title:</span> First &amp; best
<p>Unclosed<br>paragraph</div>
<div class='list-subjects'><span class='descriptor'>Subjects:</span> <span class="primary-subject">Vision (cs.CV)</span>; Robotics (cs.RO)</div></div>
<dt><a name='item2'>[2]</a> <a href="/abs/2601.00002/" title="Abstract">p2</a>
<dt><a href="/abs/2601.00009" title="Abstract">no number</a>
<dd><div class='list-subjects extra'><span class='descriptor'>Subjects:</span> Robotics (cs.RO)</div>
<p>Shared by two<p>of the items
</dl>
<dl><dt><a name='item3'>[3]</a> <a href="/abs/2601.00003" title="Abstract">p3</a></dt><dd><p>third <b>bold</dd>
<dt><a name='item4'>[4]</a> <a href="/abs/2601.00004">no title</a></dt><dd>x</dd>
<dt><a name='itemx'>[5]</a> <a href="/abs/2601.00005" title="Abstract">bad number</a></dt><dd>x</dd>
<dt><a name='item6'>[6]</a> <a href="/abs/2601.00006" title="Abstract">p6</a></dt>
</dl><dd>stray</dd></div></body></html>"""


def frame(spark, *pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")


def test_open_items_close_where_the_next_begins(spark):
    rows = listing.listing_items(frame(spark, PAGE)).orderBy("pos").collect()
    got = [(r.item_no, r.id, r.href, r.subjects, r.description, r.cutoff) for r in rows]
    assert got == [
        (1, "2601.00001", "/abs/2601.00001", "Vision (cs.CV)", "Title: First & best Unclosed paragraph Subjects: Vision (cs.CV) ; Robotics (cs.RO)", 3),
        (2, "2601.00002", "/abs/2601.00002/", "Robotics (cs.RO)", "Subjects: Robotics (cs.RO) Shared by two of the items", 3),
        (3, "2601.00003", "/abs/2601.00003", None, "third bold", 3)]


def test_cut_and_targets(spark):
    items = listing.listing_items(frame(spark, PAGE, PAGE.replace("#item", "#part")))
    assert sorted((r.page_id, r.item_no) for r in listing.cut(items).collect()) == [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3)]
    assert sorted(r.item_no for r in listing.targeted(items.where("page_id = 0"), ["cs.CV"]).collect()) == [1, 3]


def test_odd_pages(spark):
    odd = ["", "plain text", "<dl><dt><a name=item1><a title=Abstract href=/abs/7>", "<dd>x<dt><a name=item1>", "<b>" * 2000 + "</i>" * 2000,
           "<dl><dt><a name=item1><a title=Abstract href=/abs/7><dd>a<dl><dt><a name=item8><a title=Abstract href=/abs/8><dd>inner</dl>b<dt>"]
    rows = listing.listing_items(frame(spark, *odd).union(spark.createDataFrame([(None, None)], "page_id long, html string"))).collect()
    assert sorted((r.page_id, r.item_no, r.id, r.description) for r in rows) == [(5, 1, "7", "a b"), (5, 8, "8", "inner")]
    assert listing.listing_items(frame(spark, "").where("false")).count() == 0


def test_entries_are_handed_on_within_a_bound(spark):
    """a worker holds neither a whole partition's pages nor all entries of a batch."""
    page = "<dl>" + "".join(f"<dt><a name=item{i}>{i}</a><a href=/abs/{i} title=Abstract>x</a><dd>{'w' * 100_000}" for i in range(40)) + "</dl>"
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([page, None])], names=["page_id", "html"])
    out = list(listing.read_batches(iter([batch]), listing.Layout()))
    assert [x for b in out for x in b["pos"].to_pylist()] == list(range(40))
    assert max(sum(map(len, b["description"].to_pylist())) for b in out) < listing.OUT_CHARS + 100_000
    apply_confs(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"
