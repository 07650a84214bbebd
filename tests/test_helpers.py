"""Smaller operators: long-form match reasons, file-name discovery, defaults,
tagger candidates, resumable calls, approximate streaming dedup."""
import datetime as dt
import os

from pyspark.sql import functions as F

from quire.functions import papers as pf
from quire.operators import dedup, trends
from quire.sources import feed
from quire.streaming import feed_stream as fs


def test_discover_names_and_choice(spark):
    names = ["2026-01-02_AI_enhanced_English.jsonl", "2026-01-01_AI_enhanced_Chinese.jsonl",
             "2026-01-01_AI_enhanced_English.jsonl", "2026-01-02_AI_enhanced_German.jsonl", "notes.txt"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, file_name string")
    avail = feed.discover_names(df)
    assert sorted((r.date, r.language) for r in avail.collect()) == [
        ("2026-01-01", "Chinese"), ("2026-01-01", "English"), ("2026-01-02", "English")]
    chosen = {r.date: r.language for r in feed.choose_language(avail, "English", "Chinese").collect()}
    assert chosen == {"2026-01-01": "English", "2026-01-02": "English"}


def test_defaults(spark):
    df = spark.createDataFrame([("", None), ("x", 3)], "s string, n long")
    got = [tuple(r) for r in df.select(pf.or_default("s", "dflt"), pf.or_default("n", 0)).collect()]
    assert got == [("dflt", 0), ("x", 3)]


def test_tagger_candidates(spark):
    df = spark.createDataFrame([(["deep", "tactile", "sensing", "for", "robot", "hands"],
                                 ["ADJ", "ADJ", "NOUN", "ADP", "NOUN", "NOUN"])], "t array<string>, g array<string>")
    got = df.select(trends.candidates_from_tags("t", "g")).collect()[0][0]
    assert got == ["sensing", "deep tactile sensing", "robot hands"]


def test_null_id_quarantine_and_newest_first(spark):
    f = spark.createDataFrame([("a", dt.date(2026, 1, 1)), (None, dt.date(2026, 1, 3))], "id string, date date")
    ok, bad = dedup.quarantine_null_ids(f)
    assert ok.count() == 1 and bad.count() == 1
    assert [r.date for r in feed.newest_first(f).collect()] == [dt.date(2026, 1, 3), dt.date(2026, 1, 1)]


def test_approximate_stream_dedup(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    rows = [("a", dt.datetime(2026, 1, d)) for d in (1, 2, 9, 18)] + [("b", dt.datetime(2026, 1, 1))]
    spark.createDataFrame(rows, "id string, ts timestamp").write.parquet(src)
    s = spark.readStream.schema("id string, ts timestamp").parquet(src)
    out = os.path.join(tmpdir_path, "out")
    q = (fs.dedup_approx(s).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = [r.id for r in spark.read.parquet(out).collect()]
    # One batch: duplicates of an id within it collapse to one row (which one
    # is processing order); the exact rule would keep a on days 1 and 18.
    assert sorted(got) == ["a", "b"]
