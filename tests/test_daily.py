"""C1 daily pipeline: stop conditions and the published day."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from quire.plans.daily import DailyConfig, run_daily

SCHEMA = "id string, seq long, title string, summary string, authors array<string>, categories array<string>"


def summarize(prompt):
    return json.dumps({"tldr": prompt.split()[-1], "motivation": "m", "method": "me", "result": "r",
                       "conclusion": "c"})


def test_daily_flow(spark):
    hist = spark.createDataFrame([("old", dt.date(2026, 1, 9))], "id string, date date")
    today = spark.createDataFrame([
        ("old", 1, "Seen before", "abs old", ["A"], ["cs.CV"]),
        ("n1", 2, "Fresh one", "abs fresh robot", ["B"], ["cs.RO"]),
        ("n1", 3, "Fresh one again", "abs fresh robot", ["B"], ["cs.RO"]),
        ("n2", 4, "Other", "abs nicht gut", ["C"], ["cs.CV"]),
    ], SCHEMA)
    cfg = DailyConfig(run_date="2026-01-10", preference=["cs.CV"])
    r = run_daily(today, hist, cfg, summarize, safety_fn=lambda t: "nicht" in t, sleep=lambda s: None)
    assert r.status == "has_new_content"
    pub = {x.id: x.AI["tldr"] for x in r.published.collect()}
    assert pub == {"n1": "robot"}                      # old: look-back; n1 once; n2: flagged
    assert [x.reason for x in r.quarantine.collect()] == ["summary"]
    assert r.digest_lines.count() > 0


def test_daily_stop_conditions(spark):
    hist = spark.createDataFrame([("a", dt.date(2026, 1, 9))], "id string, date date")
    only_old = spark.createDataFrame([("a", 1, "t", "s", ["A"], ["cs.CV"])], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    cfg = DailyConfig(run_date="2026-01-10")
    assert run_daily(only_old, hist, cfg, summarize).status == "no_new_content"
    assert run_daily(empty, hist, cfg, summarize).status == "no_data"
    fresh = spark.createDataFrame([("b", 1, "t", "s", ["A"], ["cs.CV"])], SCHEMA)
    reject = lambda p: json.dumps({"relevant": False, "confidence": 0.99})
    cfg2 = DailyConfig(run_date="2026-01-10", topic_filter=True)
    r = run_daily(fresh, hist, cfg2, summarize, classify_fn=reject, sleep=lambda s: None)
    assert r.status == "topic_empty" and r.excluded.count() == 1


def _day(spark):
    hist = spark.createDataFrame([("old", dt.date(2026, 1, 9))], "id string, date date")
    today = spark.createDataFrame([
        ("old", 1, "Seen before", "abs old", ["A"], ["cs.CV"]),
        ("n1", 2, "Fresh one", "robot code at https://github.com/lab/robot.git and more", ["B"], ["cs.RO"]),
        ("n2", 3, "Second", "vision, see https://lab.github.io/vision.", ["C"], ["cs.CV"]),
        ("n3", 4, "Third", "no link", ["D"], ["cs.CV"]),
        ("n4", 5, "Flagged", "abs nicht gut", ["E"], ["cs.CV"])], SCHEMA)
    return today, hist


def test_published_day_and_rerun(spark, tmpdir_path):
    """Slice, digest, quarantine and manifest are written; a second run of the
    day makes no call and replaces the same outputs; other days stay."""
    from quire.plans.daily import daily_job
    from quire.sources import feed
    today, hist = _day(spark)
    log = os.path.join(tmpdir_path, "calls")

    def told(prompt):
        with open(log, "a", encoding="utf-8") as f:
            f.write("x")
        return summarize(prompt)
    root = os.path.join(tmpdir_path, "out")
    for _ in range(2):
        cfg = DailyConfig(run_date="2026-01-10", preference=["cs.CV"])
        r = daily_job(spark, today, hist, cfg, root, summarize=told, safety_fn=lambda t: "nicht" in t, sleep=lambda s: None)
        assert r.status == "has_new_content"
        rows, bad = feed.read_feed(spark, f"{root}/feed")
        got = {x.id: (x.code_url, x.code_stars, x.code_last_update) for x in rows.collect()}
        # Links are told without a facts table.
        assert got == {"n1": ("https://github.com/lab/robot", 0, ""), "n2": ("https://lab.github.io/vision", 0, ""), "n3": (None, 0, "")}
        assert bad.count() == 0
        assert [x.value for x in spark.read.text(f"{root}/file-list").collect()] == ["2026-01-10_AI_enhanced_English.jsonl"]
        assert [x.reason for x in spark.read.json(f"{root}/quarantine").collect()] == ["summary"]
        text = [x.value for x in spark.read.text(f"{root}/digest/date=2026-01-10").collect()]
        assert [x for x in text if x.startswith("### [")] == [f"### [{i}] [{t}](https://arxiv.org/abs/{k})" for i, t, k in
                                                              [(1, "Second", "n2"), (2, "Third", "n3"), (3, "Fresh one", "n1")]]
    assert len(open(log).read()) == 3                     # three papers, one call each over both runs
    nxt = today.where("id = 'n3'").withColumn("id", F.lit("n9"))
    daily_job(spark, nxt, hist, DailyConfig(run_date="2026-01-11"), root, summarize=told, sleep=lambda s: None)
    assert len(open(log).read()) == 3                     # the same text on another day is not paid for again
    names = [x.value for x in spark.read.text(f"{root}/file-list").collect()]
    assert names == ["2026-01-10_AI_enhanced_English.jsonl", "2026-01-11_AI_enhanced_English.jsonl"]


def test_nothing_is_published_without_new_content(spark, tmpdir_path):
    from quire.plans.daily import daily_job
    today, hist = _day(spark)
    root = os.path.join(tmpdir_path, "out")
    r = daily_job(spark, today.where("id = 'old'"), hist, DailyConfig(run_date="2026-01-10"), root, summarize=summarize)
    assert r.status == "no_new_content" and not os.path.exists(f"{root}/feed")


def test_failed_publish_is_put_right_by_the_next_run(spark, tmpdir_path, monkeypatch):
    from quire.operators import digest
    from quire.plans import daily
    today, hist = _day(spark)
    root, log = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "calls")

    def told(prompt):
        with open(log, "a", encoding="utf-8") as f:
            f.write("x")
        return summarize(prompt)

    def broken(*a, **k):
        raise OSError("disk")
    monkeypatch.setattr(digest, "write_digest", broken)
    try:
        daily.daily_job(spark, today, hist, DailyConfig(run_date="2026-01-10"), root, summarize=told, sleep=lambda s: None)
        raise AssertionError("should have failed")
    except OSError:
        pass
    assert not os.path.exists(f"{root}/file-list")
    monkeypatch.undo()
    daily.daily_job(spark, today, hist, DailyConfig(run_date="2026-01-10"), root, summarize=told, sleep=lambda s: None)
    assert spark.read.text(f"{root}/file-list").count() == 1 and len(open(log).read()) == 4
