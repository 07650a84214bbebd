"""Feed files (flat layout with language variants, broken and empty files),
sinks, and the streaming operators against their batch counterparts."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import dedup
from quire.sources import feed
from quire.streaming import feed_stream as fs


def _write(path, name, lines):
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


def _paper(i, cats):
    return json.dumps({"id": f"26{i:02d}", "title": f"T{i}", "summary": "s", "authors": ["a"], "categories": cats})


def test_flat_files_languages_broken_lines(spark, tmpdir_path):
    _write(tmpdir_path, "2026-01-01_AI_enhanced_Chinese.jsonl", [_paper(1, ["cs.CV"]), "{broken", _paper(2, "cs.RO")])
    _write(tmpdir_path, "2026-01-01_AI_enhanced_English.jsonl", [_paper(3, ["cs.CL", "cs.AI"]), ""])
    _write(tmpdir_path, "2026-01-02_AI_enhanced_English.jsonl", [])                       # empty file
    _write(tmpdir_path, "2026-01-02_AI_enhanced_French.jsonl", [_paper(4, ["cs.LG"])])    # not listed
    good, bad = feed.read_feed(spark, tmpdir_path, layout="flat")
    rows = {r.id: (r.language, r.categories) for r in feed.normalize(good).collect()}
    assert rows == {"2601": ("Chinese", ["cs.CV"]), "2602": ("Chinese", ["cs.RO"]), "2603": ("English", ["cs.CL", "cs.AI"])}
    assert [r.line for r in bad.collect()] == ["{broken"]
    # Files decide by their names, the empty one too; other names do not count.
    _write(tmpdir_path, "2026-01-03.jsonl", [_paper(5, ["cs.LG"])])
    _write(tmpdir_path, "notes.txt", ["x"])
    assert feed.read_feed(spark, tmpdir_path, layout="flat")[0].count() == 3
    files = feed.list_files(spark, tmpdir_path)
    assert [(r.date, r.languages) for r in feed.discover(feed.slices(files)).collect()] == [
        (dt.date(2026, 1, 2), ["English"]), (dt.date(2026, 1, 1), ["Chinese", "English"])]
    assert [r.file for r in feed.manifest(files).collect()] == [
        "2026-01-01_AI_enhanced_Chinese.jsonl", "2026-01-01_AI_enhanced_English.jsonl", "2026-01-02_AI_enhanced_English.jsonl",
        "2026-01-02_AI_enhanced_French.jsonl", "2026-01-03.jsonl"]


def test_discovery_reads_no_file_and_prunes_folders(spark, tmpdir_path):
    tmpdir_path = os.path.join(tmpdir_path, "feed")
    days = [dt.date(2026, 1, d) for d in range(1, 6)]
    rows = spark.createDataFrame([("x" * 50, d, lang) for d in days for lang in ("English", "Chinese")], "value string, date date, language string")
    rows.write.partitionBy("date", "language").text(tmpdir_path)
    feed.touch(spark, f"{tmpdir_path}/date=2026-01-09/language=English/part-0.txt")
    files = feed.list_files(spark, tmpdir_path, "2026-01-04", "2026-01-31")
    assert {r.date for r in feed.discover(feed.slices(files)).collect()} == {dt.date(2026, 1, 4), dt.date(2026, 1, 5), dt.date(2026, 1, 9)}
    assert feed.discover(feed.slices(files)).first().languages == ["English"]
    plan = feed.manifest(files)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and files.count() == 5                    # two slices a day and the empty one
    assert [r.file for r in feed.manifest(files).collect()][-1] == "2026-01-09_AI_enhanced_English.jsonl"


def test_chosen_language_prunes_while_running(spark, tmpdir_path):
    from quire.operators import trends
    tmpdir_path = os.path.join(tmpdir_path, "feed")
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    rows = [("1", "robot grasping", d1, "English"), ("1", "Roboter greifen", d1, "German"), ("2", "robot walking", d2, "German"),
            ("3", "robot vision", d2, "French")]
    spark.createDataFrame(rows, "id string, title string, date date, language string").write.partitionBy("date", "language").parquet(tmpdir_path)
    papers, listed = spark.read.parquet(tmpdir_path), feed.slices(feed.list_files(spark, tmpdir_path))
    stats = trends.keyword_statistics(papers, preferred="English", default="German", listed=listed)
    assert sorted((r.id, r.keyword) for r in stats["keywords"].collect()) == [("1", "robot grasping"), ("2", "robot walking")]
    plan = feed.in_language(papers, "English", "German", listed)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_language_choice(spark):
    avail = spark.createDataFrame([("d1", "English", 1), ("d1", "Chinese", 0), ("d2", "English", 0),
                                   ("d3", "German", 1), ("d3", "French", 0)],
                                  "date string, language string, listing_pos int")
    got = {r.date: r.language for r in feed.choose_language(avail, "Chinese", "English").collect()}
    assert got == {"d1": "Chinese", "d2": "English", "d3": "French"}       # first listed otherwise


def test_strict_scan_fails_on_bad_line(spark, tmpdir_path):
    _write(tmpdir_path, "2026-01-01_AI_enhanced_English.jsonl", [_paper(1, ["cs.CV"]), "{oops"])
    good, _ = feed.read_feed(spark, tmpdir_path, mode="strict", layout="flat")
    try:
        good.collect()
        raise AssertionError("strict scan accepted a bad line")
    except Exception as e:
        assert "AssertionError" not in type(e).__name__


def test_overwrite_sink_replaces_only_its_day(spark, tmpdir_path):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    df = spark.createDataFrame([("a", d1, "English"), ("b", d2, "English")], "id string, date date, language string")
    feed.write_feed(df, tmpdir_path, fmt="parquet")
    feed.write_feed(spark.createDataFrame([("c", d2, "English")], df.schema), tmpdir_path, fmt="parquet")
    got = sorted((r.id, r.date) for r in spark.read.parquet(tmpdir_path).collect())
    assert got == [("a", d1), ("c", d2)]


def _daily_files(spark, root, rows):
    """One folder per day, written in date order (one file each)."""
    df = spark.createDataFrame(rows, "id string, date date, seq long")
    for d in sorted({r[1] for r in rows}):
        (df.where(F.col("date") == d).select(F.to_json(F.struct("id", "seq")).alias("value")).coalesce(1)
         .write.text(os.path.join(root, f"date={d.isoformat()}")))
    return df


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.LongType())])
PART = T.StructType([T.StructField("date", T.DateType())])


def _rows():
    base = dt.date(2026, 1, 1)
    return ([("a", base + dt.timedelta(days=n), n) for n in range(20)]
            + [("b", base + dt.timedelta(days=n), 100 + n) for n in (0, 7, 8)]
            + [("c", base + dt.timedelta(days=3), 200), ("c", base + dt.timedelta(days=3), 201)])


def test_stream_exact_dedup_equals_fold(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    df = _daily_files(spark, src, _rows())
    stream = fs.read_feed_stream(spark, src, SCHEMA, PART, max_files=3)     # several days per batch
    q = fs.run_lookback_dedup(stream, os.path.join(tmpdir_path, "store"), os.path.join(tmpdir_path, "ck"))
    q.awaitTermination()
    got = sorted(r.seq for r in spark.read.parquet(os.path.join(tmpdir_path, "store")).collect())
    want = sorted(r.seq for r in dedup.backfill_dedup(df).collect())
    assert got == want


def test_stream_state_machine_with_timers(spark, tmpdir_path):
    """One day per trigger: equals the fold; null ids all pass; an id's state ends with its look-back."""
    src = os.path.join(tmpdir_path, "src")
    rows = [*_rows(), (None, dt.date(2026, 1, 2), 300), (None, dt.date(2026, 1, 3), 301), ("late", dt.date(2026, 1, 20), 400)]
    df = _daily_files(spark, src, rows)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, fs.STATE_STORE)
    try:
        stream = fs.read_feed_stream(spark, src, SCHEMA, PART, max_files=1)
        out = fs.dedup_with_state(stream)
        q = (out.writeStream.format("parquet").option("path", os.path.join(tmpdir_path, "out"))
             .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    got = sorted(r.seq for r in spark.read.parquet(os.path.join(tmpdir_path, "out")).collect())
    want = sorted(r.seq for r in dedup.backfill_dedup(df).collect())
    assert got == want and {300, 301} <= set(got)
    held = spark.read.format("statestore").option("stateVarName", "last_kept").load(os.path.join(tmpdir_path, "ck"))
    assert sorted(r.key.id for r in held.collect()) == ["a", "late"]        # b's and c's look-backs are over


def test_lookback_state_stays_compact(spark, tmpdir_path):
    src, store, ck = (os.path.join(tmpdir_path, x) for x in ("src", "store", "ck"))
    df = _daily_files(spark, src, [*_rows(), (None, dt.date(2026, 1, 2), 300), (None, dt.date(2026, 1, 3), 301)])
    stream = fs.read_feed_stream(spark, src, SCHEMA, PART, max_files=1)
    fs.run_lookback_dedup(stream, store, ck).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(store).collect()) == sorted(r.seq for r in dedup.backfill_dedup(df).collect())
    versions = sorted(os.listdir(ck + "-state"))
    assert len(versions) == 2                                               # the newest and the one a replay needs
    newest = max(versions, key=lambda v: int(v.partition("=")[2]))
    assert [(r.id, r.last_kept) for r in spark.read.parquet(os.path.join(ck + "-state", newest)).collect()] == [("a", dt.date(2026, 1, 17))]
    # A replayed batch reads the version before its own and replaces its own output.
    last = int(newest.partition("=")[2])
    fs.dedup_batch_writer(store, ck + "-state")(df.where("date = '2026-01-20'"), last)
    assert sorted(r.seq for r in spark.read.parquet(store).collect()) == sorted(r.seq for r in dedup.backfill_dedup(df).collect())


def test_incremental_ingest_reads_only_new_files(spark, tmpdir_path):
    src, ck, out = (os.path.join(tmpdir_path, x) for x in ("src", "ck", "out"))
    os.makedirs(src)
    _write(src, "a.jsonl", [_paper(1, ["cs.CV"])])

    def run():
        s = fs.read_feed_stream(spark, src)
        q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(out).count()
    assert run() == 1
    _write(src, "b.jsonl", [_paper(2, ["cs.RO"]), _paper(3, ["cs.RO"])])
    assert run() == 3                    # the first file is not read again


def test_absent_day_is_empty(spark, tmpdir_path):
    df = feed.read_day(spark, os.path.join(tmpdir_path, "nothing-here"), "2026-01-01")
    assert df.count() == 0


def _classified(spark, rows):
    from quire.operators import topic
    return topic.classify(spark.createDataFrame(rows, "i int, response string, status string, date date"))


YES, NO = json.dumps({"relevant": True, "confidence": 0.9}), json.dumps({"relevant": False, "confidence": 0.9})


def _pair(spark, root):
    from quire.operators import topic
    out = []
    for name in ("kept", "excluded"):
        rows = topic.read_split(spark, root, name)
        out.append(sorted(r.i for r in rows.collect()) if rows is not None else None)
    return out


def test_split_sink_and_empty_guard(spark, tmpdir_path):
    from quire.operators import topic, versions
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    root = os.path.join(tmpdir_path, "split")
    assert _pair(spark, root) == [None, None]
    assert topic.write_split(_classified(spark, [(1, YES, "ok", d1), (2, NO, "ok", d1), (3, YES, "ok", d2)]), root) == topic.STATUS_OK
    assert _pair(spark, root) == [[1, 3], [2]]
    assert topic.write_split(_classified(spark, [(9, NO, "ok", d1)]), root) == topic.STATUS_EMPTY
    assert _pair(spark, root) == [[1, 3], [2]]                       # input left unchanged, nothing written
    assert topic.write_split(_classified(spark, [(4, YES, "ok", d1), (5, NO, "ok", d2), (6, YES, "ok", dt.date(2026, 1, 3))]), root) == 0
    assert _pair(spark, root) == [[4, 6], [5]]                       # both days are the new run's, in both outputs
    versions.sweep(spark, root)
    assert _pair(spark, root) == [[4, 6], [5]] and len(os.listdir(os.path.join(root, "versions"))) == 1


def test_failure_between_the_writes_leaves_the_old_pair(spark, tmpdir_path, monkeypatch):
    from quire.operators import topic, versions
    d1 = dt.date(2026, 1, 1)
    root = os.path.join(tmpdir_path, "split")
    topic.write_split(_classified(spark, [(1, YES, "ok", d1), (2, NO, "ok", d1)]), root)
    real = versions.folder

    def broken(root, version, name):
        if name == "excluded":
            raise OSError("no space left")
        return real(root, version, name)
    monkeypatch.setattr(versions, "folder", broken)
    try:
        topic.write_split(_classified(spark, [(3, YES, "ok", d1), (4, NO, "ok", d1)]), root)
        raise AssertionError("the second write should have failed")
    except OSError:
        pass
    monkeypatch.undo()
    assert _pair(spark, root) == [[1], [2]]
    monkeypatch.setattr(versions, "_pointers", lambda spark, root: [])      # a run that does not see the other's pointer
    try:
        versions.switch(spark, root, {"2026-01-01": "x"})
        raise AssertionError("the number is taken")
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert _pair(spark, root) == [[1], [2]]


def test_ingest_reads_once_into_two_sinks(spark, tmpdir_path):
    src, ck, rows, bad = (os.path.join(tmpdir_path, x) for x in ("src", "ck", "rows", "bad"))
    os.makedirs(src)
    _write(src, "a.jsonl", [_paper(1, ["cs.CV"]), '{"id": "cut', "", _paper(2, ["cs.CV"])])
    fs.run_ingest(fs.read_lines_stream(spark, src), rows, bad, ck).awaitTermination()
    _write(src, "b.jsonl", [_paper(3, ["cs.RO"]), "not json"])
    q = fs.run_ingest(fs.read_lines_stream(spark, src), rows, bad, ck)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) <= 2            # only the new file, read once
    assert sorted(r.id for r in spark.read.parquet(rows).collect()) == ["p1", "p2", "p3"] or spark.read.parquet(rows).count() == 3
    assert sorted((r.line, os.path.basename(r.file)) for r in spark.read.parquet(bad).collect()) == [("not json", "b.jsonl"), ('{"id": "cut', "a.jsonl")]
    write = fs.ingest_writer(rows, bad)
    again = spark.createDataFrame([("not json", "b.jsonl")], "value string, file string")
    write(again, 7)
    write(again, 7)                                                         # a replay replaces its own output
    assert spark.read.parquet(bad).where("batch = 7").count() == 1


def test_publish_per_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    ai = {"tldr": "t", "motivation": "m", "method": "x", "result": "r", "conclusion": "c"}
    lines = [json.dumps({"id": f"p{i}", "title": f"T{i}", "summary": "s", "authors": ["a"], "categories": ["cs.CV"],
                         "AI": ai}) for i in range(3)]
    _write(src, "day.jsonl", lines)
    s = fs.read_feed_stream(spark, src).withColumn("date", F.lit("2026-01-03").cast("date")) \
        .withColumn("language", F.lit("English"))
    out, dig = os.path.join(tmpdir_path, "feed"), os.path.join(tmpdir_path, "digest")
    q = (s.writeStream.foreachBatch(fs.publish_writer(out, dig)).option("checkpointLocation",
         os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    text = spark.read.text(dig).collect()
    assert any(r.value.startswith("### [3]") for r in text)
