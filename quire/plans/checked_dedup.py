"""Checked queries: look-back dedup (J1, U2, U3, A5), first-seen (W1), backfill
fold, unions and distincts (U1, U4, U5)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tf
from ..operators import dedup
from ..session import apply_confs
from ..sources.tables import document_feed, event_feed, load_table, papers_view
from .oracle_views import DOC_FEED, EVENT_FEED, PAPERS, with_
from .registry import register

RUN_DATE = "2024-01-15"
D = f"DATE '{RUN_DATE}'"


def _events(spark, sf_dir):
    apply_confs(spark)
    return event_feed(load_table(spark, sf_dir, "events"))


def _docs(spark, sf_dir):
    apply_confs(spark)
    return document_feed(load_table(spark, sf_dir, "documents"))


LOOKBACK = f"date BETWEEN {D} - INTERVAL 7 DAY AND {D} - INTERVAL 1 DAY"


@register("j1_lookback_antijoin", with_(EVENT_FEED) + f"""
SELECT seq, id, strftime(date, '%Y-%m-%d') AS date FROM feed t
WHERE date = {D} AND NOT EXISTS (SELECT 1 FROM feed h WHERE h.id = t.id AND h.{LOOKBACK})""")
def j1_lookback_antijoin(spark, sf_dir):
    r = dedup.lookback_antijoin(_events(spark, sf_dir), RUN_DATE)
    return r.select("seq", "id", tf.iso_date("date").alias("date"))


@register("j1_lookback_antijoin_docs", with_(DOC_FEED) + f"""
SELECT seq, id FROM dfeed t
WHERE date = {D} AND NOT EXISTS (SELECT 1 FROM dfeed h WHERE h.id = t.id AND h.{LOOKBACK})""")
def j1_lookback_antijoin_docs(spark, sf_dir):
    return dedup.lookback_antijoin(_docs(spark, sf_dir), RUN_DATE).select("seq", "id")


@register("u2_lookback_ids", with_(EVENT_FEED) + f"SELECT DISTINCT id FROM feed WHERE {LOOKBACK}")
def u2_lookback_ids(spark, sf_dir):
    return dedup.lookback_ids(_events(spark, sf_dir), RUN_DATE)


@register("u3_duplicate_ids", with_(EVENT_FEED) + f"""
SELECT DISTINCT id FROM feed WHERE date = {D}
INTERSECT SELECT DISTINCT id FROM feed WHERE {LOOKBACK}""")
def u3_duplicate_ids(spark, sf_dir):
    return dedup.duplicate_ids(_events(spark, sf_dir), RUN_DATE)


REPORT_SQL = """
, t AS (SELECT id, count(*) AS n FROM {f} WHERE date = {d} GROUP BY id)
, h AS (SELECT DISTINCT id FROM {f} WHERE {lb})
, r AS (
  SELECT CAST(coalesce((SELECT sum(n) FROM t), 0) AS BIGINT) AS today_total,
         CAST((SELECT count(*) FROM h) AS BIGINT) AS lookback_size,
         CAST((SELECT count(*) FROM t JOIN h USING (id)) AS BIGINT) AS duplicates,
         CAST(coalesce((SELECT sum(n) FROM t JOIN h USING (id)), 0) AS BIGINT) AS removed,
         CAST(coalesce((SELECT sum(n) FROM t WHERE id NOT IN (SELECT id FROM h)), 0) AS BIGINT) AS remaining)
SELECT *, CASE WHEN today_total = 0 THEN '%s' WHEN remaining = 0 THEN '%s' ELSE '%s' END AS status FROM r""" % (
    fixed.STATUS_NO_DATA, fixed.STATUS_NO_NEW, fixed.STATUS_HAS_NEW)


@register("a5_dedup_report", with_(EVENT_FEED) + REPORT_SQL.format(f="feed", d=D, lb=LOOKBACK))
def a5_dedup_report(spark, sf_dir):
    return dedup.dedup_report(_events(spark, sf_dir), RUN_DATE)


@register("a5_dedup_report_docs", with_(DOC_FEED) + REPORT_SQL.format(f="dfeed", d=D, lb=LOOKBACK))
def a5_dedup_report_docs(spark, sf_dir):
    return dedup.dedup_report(_docs(spark, sf_dir), RUN_DATE)


@register("a5_dedup_report_empty_day", with_(EVENT_FEED) + REPORT_SQL.format(
    f="feed", d="DATE '2024-03-01'", lb=LOOKBACK.replace(D, "DATE '2024-03-01'")))
def a5_dedup_report_empty_day(spark, sf_dir):
    """A day after the feed ends: status ``no_data``."""
    return dedup.dedup_report(_events(spark, sf_dir), "2024-03-01")


@register("w1_first_seen", with_(DOC_FEED) + """
SELECT id, arg_min(seq, seq) AS seq, arg_min(source, seq) AS source, arg_min(lang, seq) AS lang,
       strftime(arg_min(date, seq), '%Y-%m-%d') AS date
FROM dfeed WHERE seq % 17 <> 0 GROUP BY id
UNION ALL SELECT NULL, seq, source, lang, strftime(date, '%Y-%m-%d') FROM dfeed WHERE seq % 17 = 0""")
def w1_first_seen(spark, sf_dir):
    """Every 17th row lost its id: such rows are nobody's copies."""
    d = _docs(spark, sf_dir)
    r = dedup.first_seen(d.withColumn("id", F.when(F.col("seq") % 17 != 0, F.col("id"))))
    return r.select("id", "seq", "source", "lang", tf.iso_date("date").alias("date"))


FOLD_SQL = """
WITH RECURSIVE {view},
d AS (SELECT DISTINCT id, date FROM {f} WHERE id IS NOT NULL),
o AS (SELECT id, date, row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM d),
k AS (
  SELECT id, rn, date, date AS last_kept, true AS kept FROM o WHERE rn = 1
  UNION ALL
  SELECT o.id, o.rn, o.date,
         CASE WHEN o.date - k.last_kept > 7 THEN o.date ELSE k.last_kept END,
         o.date - k.last_kept > 7
  FROM k JOIN o ON o.id = k.id AND o.rn = k.rn + 1)
SELECT f.seq, f.id, strftime(f.date, '%Y-%m-%d') AS date
FROM {f} f JOIN k ON f.id = k.id AND f.date = k.date AND k.kept"""


@register("backfill_fold_dedup", FOLD_SQL.format(view=EVENT_FEED, f="feed"))
def backfill_fold_dedup(spark, sf_dir):
    r = dedup.backfill_dedup(_events(spark, sf_dir))
    return r.select("seq", "id", tf.iso_date("date").alias("date"))


@register("backfill_fold_dedup_docs", FOLD_SQL.format(view=DOC_FEED, f="dfeed"))
def backfill_fold_dedup_docs(spark, sf_dir):
    r = dedup.backfill_dedup(_docs(spark, sf_dir))
    return r.select("seq", "id", tf.iso_date("date").alias("date"))


@register("u1_union_of_feeds", with_(EVENT_FEED, DOC_FEED) + """
SELECT strftime(date, '%Y-%m-%d') AS date, kind, CAST(count(*) AS BIGINT) AS n,
       CAST(count(source) AS BIGINT) AS n_with_source
FROM (SELECT date, 'event' AS kind, NULL AS source FROM feed
      UNION ALL SELECT date, 'document', source FROM dfeed)
GROUP BY ALL""")
def u1_union_of_feeds(spark, sf_dir):
    """Feeds of different shapes stacked by name; missing columns are null."""
    ev = _events(spark, sf_dir).withColumn("kind", F.lit("event"))
    dc = _docs(spark, sf_dir).withColumn("kind", F.lit("document"))
    u = ev.unionByName(dc, allowMissingColumns=True)
    return u.groupBy(tf.iso_date("date").alias("date"), "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("source").alias("n_with_source"))


@register("u4_distinct_dates", with_(EVENT_FEED) + "SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM feed")
def u4_distinct_dates(spark, sf_dir):
    return _events(spark, sf_dir).select(tf.iso_date("date").alias("date")).distinct()


@register("u5_distinct_primary_categories", with_(PAPERS) + "SELECT DISTINCT primary_category FROM papers")
def u5_distinct_primary_categories(spark, sf_dir):
    apply_confs(spark)
    return papers_view(load_table(spark, sf_dir, "documents")).select("primary_category").distinct()


# --- streaming ----------------------------------------------------------------
def _stream_export(spark, sf_dir) -> str:
    """Export the event feed as JSON lines, one folder per day."""
    import uuid

    from ..session import checkpoint_dir
    ev = _events(spark, sf_dir)
    line = F.to_json(F.struct("id", "seq", "event_type"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/stream-src-{uuid.uuid4().hex}"
    ev.select("date", line.alias("value")).write.partitionBy("date").text(path)
    return path


@register("t2_stream_lookback_dedup", FOLD_SQL.format(view=EVENT_FEED, f="feed"))
def t2_stream_lookback_dedup(spark, sf_dir):
    """T2 exact as a stream (availableNow): equals the day-by-day fold."""
    import uuid

    from pyspark.sql import types as T

    from ..session import checkpoint_dir
    from ..streaming import feed_stream as fs
    src = _stream_export(spark, sf_dir)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    part = T.StructType([T.StructField("date", T.DateType())])
    stream = fs.read_feed_stream(spark, src, schema, part)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = fs.run_lookback_dedup(stream, f"{base}/store", f"{base}/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/store")
    return out.select("seq", "id", tf.iso_date("date").alias("date"))


@register("t3_stream_daily_counts", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, event_type, count(*) AS n FROM events GROUP BY ALL""")
def t3_stream_daily_counts(spark, sf_dir):
    """Daily counts per event type from a stream, all days that are there."""
    import uuid

    from ..session import checkpoint_dir
    from ..streaming import feed_stream as fs
    apply_confs(spark)
    ev = load_table(spark, sf_dir, "events")
    base = f"{checkpoint_dir(spark).rstrip('/')}/t3-{uuid.uuid4().hex}"
    ev.write.parquet(f"{base}/src")
    stream = spark.readStream.schema(ev.schema).parquet(f"{base}/src")
    fs.run_daily_counts(stream, "event_type", f"{base}/out", f"{base}/ckpt").awaitTermination()
    out = fs.stored_daily_counts(spark, f"{base}/out", "event_type")
    return out.select(tf.iso_date("date").alias("date"), "event_type", "n")
