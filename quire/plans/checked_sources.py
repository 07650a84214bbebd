"""Checked queries: feed files (S1-S8, S11), page extraction (S14, S15, P9,
P10, F1, F2, J8).

The feed queries export the ``papers`` view as JSON lines, partitioned by
``(date, language)``, into a fresh folder under the session's checkpoint
directory (with a cut-off copy of some lines, to exercise the tolerant
reader), then read it back with the feed readers.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as tf
from ..session import apply_confs, checkpoint_dir
from ..sources import feed, listing, pages
from ..sources.tables import load_table, papers_view
from .oracle_views import PAPERS, with_
from .registry import register

BROKEN_EVERY = 97       # every 97th paper also gets a cut-off copy of its line
DAY = "2024-01-09"
RANGE = ("2024-01-05", "2024-01-08")
PREFERRED, DEFAULT = "fr", "en"


def _export(spark, sf_dir, clean: bool = False) -> str:
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents"))
    line = F.to_json(F.struct("id", "title", "summary", "authors", "categories", "seq"))
    rows = p.select("date", "language", line.alias("value"))
    if not clean:
        cut = p.where(F.col("seq") % BROKEN_EVERY == 0).select(
            "date", "language", F.substring(line, 1, 20).alias("value"))
        rows = rows.unionByName(cut)
    path = f"{checkpoint_dir(spark).rstrip('/')}/feed-export-{uuid.uuid4().hex}"
    rows.write.partitionBy("date", "language").text(path)
    return path


def _read(spark, sf_dir, mode="tolerant", clean=False):
    path = _export(spark, sf_dir, clean)
    good, bad = feed.read_feed(spark, path, mode=mode)
    return feed.normalize(good), bad


@register("s1_tolerant_scan", with_(PAPERS) + """
SELECT id, title, strftime(date, '%Y-%m-%d') AS date, language, primary_category,
       array_to_string(categories, ',') AS categories
FROM papers""")
def s1_tolerant_scan(spark, sf_dir):
    good, _ = _read(spark, sf_dir)
    return good.select("id", "title", tf.iso_date("date").alias("date"), "language", "primary_category",
                       F.array_join("categories", ",").alias("categories"))


@register("s1_quarantine", with_(PAPERS) + f"""
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS bad_lines FROM papers WHERE seq % {BROKEN_EVERY} = 0
GROUP BY ALL""")
def s1_quarantine(spark, sf_dir):
    _, bad = _read(spark, sf_dir)
    d = F.regexp_extract("_file", r"date=(\d{4}-\d{2}-\d{2})", 1)
    return bad.groupBy(d.alias("date")).agg(F.count(F.lit(1)).alias("bad_lines"))


@register("s2_strict_scan", with_(PAPERS) + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS n FROM papers GROUP BY ALL""")
def s2_strict_scan(spark, sf_dir):
    good, _ = _read(spark, sf_dir, mode="strict", clean=True)
    return good.groupBy(tf.iso_date("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))


EMPTY_DAY = ("2024-02-07", "en")        # a slice whose only file is empty


def _export_with_empty(spark, sf_dir) -> str:
    """A clean export and one more slice with an empty file."""
    path = _export(spark, sf_dir, clean=True)
    feed.touch(spark, f"{path}/date={EMPTY_DAY[0]}/language={EMPTY_DAY[1]}/part-empty.txt")
    return path


SLICES_SQL = with_(PAPERS) + f"""
, slices AS (SELECT DISTINCT date, language FROM papers UNION SELECT DATE '{EMPTY_DAY[0]}', '{EMPTY_DAY[1]}')
"""


@register("s4_partition_discovery", SLICES_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS date, array_to_string(list_sort(list(language)), ',') AS languages FROM slices GROUP BY date""")
def s4_partition_discovery(spark, sf_dir):
    """S4 from the folder's listing: no file is read, an empty one counts."""
    d = feed.available(spark, _export_with_empty(spark, sf_dir))
    return d.select(tf.iso_date("date").alias("date"), F.array_join("languages", ",").alias("languages"))


@register("s5_language_choice", SLICES_SQL + f"""
SELECT strftime(date, '%Y-%m-%d') AS date, language FROM slices
QUALIFY row_number() OVER (PARTITION BY date ORDER BY
  CASE WHEN language = '{PREFERRED}' THEN 0 WHEN language = '{DEFAULT}' THEN 1 ELSE 2 END, language) = 1""")
def s5_language_choice(spark, sf_dir):
    avail = feed.slices(feed.list_files(spark, _export_with_empty(spark, sf_dir)))
    ch = feed.choose_language(avail, PREFERRED, DEFAULT)
    return ch.select(tf.iso_date("date").alias("date"), "language")


@register("s6_date_scan", with_(PAPERS) + f"SELECT id, language FROM papers WHERE date = DATE '{DAY}'")
def s6_date_scan(spark, sf_dir):
    good, _ = _read(spark, sf_dir, clean=True)
    return good.where(F.col("date") == F.lit(DAY).cast("date")).select("id", "language")


@register("s7_date_range", with_(PAPERS) + f"""
SELECT id, strftime(date, '%Y-%m-%d') AS date FROM papers WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def s7_date_range(spark, sf_dir):
    good, _ = _read(spark, sf_dir, clean=True)
    return feed.date_range(good, *RANGE).select("id", tf.iso_date("date").alias("date"))


@register("s8_overwrite_sink", with_(PAPERS) + f"""
SELECT id, CASE WHEN date = DATE '{DAY}' THEN concat('v2 ', title) ELSE title END AS title,
       strftime(date, '%Y-%m-%d') AS date
FROM papers""")
def s8_overwrite_sink(spark, sf_dir):
    """Re-publishing one day replaces that day only."""
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents")).select("id", "title", "date", "language")
    path = f"{checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}"
    feed.write_feed(p, path, fmt="parquet")
    day = p.where(F.col("date") == F.lit(DAY).cast("date")).withColumn("title", F.concat(F.lit("v2 "), "title"))
    feed.write_feed(day, path, fmt="parquet")
    back = spark.read.parquet(path)
    return back.select("id", "title", tf.iso_date("date").alias("date"))


@register("s11_manifest", SLICES_SQL + """
SELECT concat(strftime(date, '%Y-%m-%d'), '_AI_enhanced_', language, '.jsonl') AS file FROM slices""")
def s11_manifest(spark, sf_dir):
    """Bare names of the exported feed's data files, sorted."""
    return feed.manifest(feed.list_files(spark, _export_with_empty(spark, sf_dir)))


# --- pages -------------------------------------------------------------------
ENT_SQL = "replace(replace(replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), " \
          "'&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _text_of_sql(frag: str) -> str:
    return (f"array_to_string(list_filter(list_transform(string_split_regex({frag}, '<[^>]*>'), "
            f"lambda p: trim({ENT_SQL.format(x='p')}, {WS})), lambda p: p <> ''), ' ')")


def _inner_sql(html: str, tag: str) -> str:
    return f"regexp_extract({html}, '(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1)"


def _strip_desc_sql(x: str, d: str) -> str:
    return f"CASE WHEN starts_with(trim({x}, {WS}), '{d}') THEN trim(substring(trim({x}, {WS}), {len(d) + 1}), {WS}) " \
           f"ELSE trim({x}, {WS}) END"


@register("s15_page_record", f"""
SELECT page_id, url,
       {_strip_desc_sql(_text_of_sql(_inner_sql('html', 'h1')), 'Title:')} AS title,
       {_strip_desc_sql(_text_of_sql("regexp_replace(" + _inner_sql('html', 'article') + ", '(?s)<h1(?:\\s[^>]*)?>.*?</h1>', '')"), 'Abstract:')} AS summary,
       nullif(regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS lang,
       array_to_string(regexp_extract_all({_inner_sql('html', 'nav')}, 'href="([^"]*)"', 1), '|') AS links
FROM pages""")
def s15_page_record(spark, sf_dir):
    apply_confs(spark)
    r = pages.page_record(load_table(spark, sf_dir, "pages"))
    return r.select("page_id", "url", "title", "summary", "lang", F.array_join("links", "|").alias("links"))


@register("f2_listing_cutoff", f"""
WITH s AS (SELECT page_id, string_split({_inner_sql('html', 'article')}, '<p>')[2:] AS ps FROM pages),
a AS (SELECT page_id, ps, list_max(list_filter(list_transform(ps, lambda x, i: CASE WHEN starts_with(x, '<b>') THEN i END),
                                             lambda i: i IS NOT NULL)) AS cut FROM s)
SELECT page_id, CAST(len(ps) AS INTEGER) AS n_paragraphs,
       CAST(CASE WHEN cut IS NULL THEN len(ps) ELSE cut - 1 END AS INTEGER) AS n_kept
FROM a""")
def f2_listing_cutoff(spark, sf_dir):
    """paragraphs before the last bold-led section start are kept."""
    apply_confs(spark)
    s = pages.section_paragraphs(load_table(spark, sf_dir, "pages"))
    kept = pages.listing_cutoff("paragraphs", lambda x: x.startswith("<b>"))
    return s.select("page_id", F.size("paragraphs").alias("n_paragraphs"), F.size(kept).alias("n_kept"))


SUBJ_SQL = """subj AS (
  SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'Subjects: none'
                         ELSE concat('Subjects: Segment (', c_mktsegment, '); Nation (n', CAST(c_nationkey AS VARCHAR), ')') END AS s
  FROM customer)"""
TARGETS = ["BUILDING", "n7"]


def _subjects(spark, sf_dir):
    apply_confs(spark)
    c = load_table(spark, sf_dir, "customer")
    s = F.when(F.col("c_custkey") % 9 == 0, F.lit("Subjects: none")).otherwise(F.concat(
        F.lit("Subjects: Segment ("), F.col("c_mktsegment"), F.lit("); Nation (n"),
        F.col("c_nationkey").cast("string"), F.lit(")")))
    return c.select("c_custkey", s.alias("s"))


@register("p10_subject_codes", with_(SUBJ_SQL) + """
SELECT c_custkey, array_to_string(regexp_extract_all(s, '\\(([^)]+)\\)', 1), '|') AS codes FROM subj""")
def p10_subject_codes(spark, sf_dir):
    return _subjects(spark, sf_dir).select("c_custkey", F.array_join(pages.subject_codes("s"), "|").alias("codes"))


@register("f1_target_overlap", with_(SUBJ_SQL) + f"""
, c AS (SELECT c_custkey, regexp_extract_all(s, '\\(([^)]+)\\)', 1) AS codes FROM subj)
SELECT c_custkey FROM c JOIN subj USING (c_custkey)
WHERE s IS NULL OR list_has_any(codes, {'[' + ', '.join(repr(t) for t in TARGETS) + ']'})""")
def f1_target_overlap(spark, sf_dir):
    return _subjects(spark, sf_dir).where(pages.target_overlap("s", TARGETS)).select("c_custkey")


@register("s14_listing_entries")
def s14_listing_entries(spark, sf_dir):
    """Nav links of every page through an HTML tokenizer (rows-only)."""
    apply_confs(spark)
    e = pages.listing_entries(load_table(spark, sf_dir, "pages"), tags=("a", "h1", "p"))
    return e.where(F.col("tag") == "a").select("page_id", "pos", "href", "text")


@register("j8_entry_pairing")
def j8_entry_pairing(spark, sf_dir):
    """Every page heading with the paragraph that follows it (rows-only)."""
    apply_confs(spark)
    e = pages.listing_entries(load_table(spark, sf_dir, "pages"), tags=("h1", "p"))
    return pages.pair_entries(e, "h1", "p")


# Listing pages of 25 entries each, made of the documents; no dt, dd, li or p is closed.
PER_PAGE = 25
ITEMS_SQL = f"""items AS (
  SELECT doc_id // {PER_PAGE} AS page_id, doc_id % {PER_PAGE} + 1 AS item_no, CAST(doc_id AS VARCHAR) AS id, concat('/abs/', doc_id) AS href,
         concat(source, ' (', lang, ')') AS subjects, 18 + (doc_id // {PER_PAGE}) % 5 AS cutoff,
         trim(concat(source, ' (', lang, ') ', trim(coalesce(text, ''), {WS}))) AS description
  FROM documents)"""


def _escaped(c):
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def listing_pages(spark, sf_dir):
    """``(page_id, html)``: a page's entries are bounded, so they are gathered by page."""
    d = load_table(spark, sf_dir, "documents")
    no = F.col("doc_id") % PER_PAGE + 1
    entry = F.format_string("<dt><a name='item%d'>[%d]</a> <a href=\"/abs/%d\" title=\"Abstract\">link</a>"
                            "<dd><div class='list-subjects'><span class=\"primary-subject\">%s (%s)</span></div><p>%s",
                            no, no, F.col("doc_id"), "source", "lang", _escaped(F.coalesce("text", F.lit(""))))
    page = F.floor(F.col("doc_id") / PER_PAGE)
    rows = d.groupBy(page.alias("page_id")).agg(F.array_sort(F.collect_list(F.struct("doc_id", entry.alias("e")))).alias("x"))
    index = F.format_string("<div id=dlpage><ul><li><a href='#item1'>New</a><li><a href='#item%d'>Replaced</a></ul>", 18 + F.col("page_id") % 5)
    return rows.select("page_id", F.concat(F.lit("<html><body>"), index, F.lit("<dl>"), F.array_join(F.transform("x", lambda s: s.getField("e")), "\n"),
                                           F.lit("</dl></div></body></html>")).alias("html"))


@register("s14_listing_items", with_(ITEMS_SQL) + "SELECT page_id, item_no, id, href, subjects, description, cutoff FROM items")
def s14_listing_items(spark, sf_dir):
    """S14 + J8: numbered entries with their descriptions."""
    return listing.listing_items(listing_pages(spark, sf_dir)).drop("pos")


@register("f2_listing_items", with_(ITEMS_SQL) + "SELECT page_id, item_no, id FROM items WHERE item_no < cutoff AND subjects LIKE '%(de)'")
def f2_listing_items(spark, sf_dir):
    """F2 + F1: entries before the last section, with a targeted code."""
    items = listing.listing_items(listing_pages(spark, sf_dir))
    return listing.targeted(listing.cut(items), ["de"]).select("page_id", "item_no", "id")


@register("f18_date_ceiling", with_(PAPERS) + """
, req AS (SELECT CAST(d AS DATE) AS date FROM range(DATE '2024-01-20', DATE '2024-02-10', INTERVAL 1 DAY) t(d))
SELECT strftime(date, '%Y-%m-%d') AS date FROM req WHERE date <= (SELECT max(date) FROM papers)""")
def f18_date_ceiling(spark, sf_dir):
    """requested days after the newest available day are dropped."""
    apply_confs(spark)
    p = papers_view(load_table(spark, sf_dir, "documents"))
    req = spark.range(0, 21).select(F.date_add(F.lit("2024-01-20").cast("date"), F.col("id").cast("int")).alias("date"))
    return feed.up_to_newest(req, p).select(tf.iso_date("date").alias("date"))
