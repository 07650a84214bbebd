"""No operator loses or multiplies rows: repeated and null ids, repeated lookup
rows, replayed and second batches, writes beside other days."""
import datetime as dt

from pyspark.sql import functions as F

from quire.operators import digest, fill, topic
from quire.streaming import feed_stream as fs

D = dt.date(2026, 1, 5)


def test_lookups_with_repeated_keys(spark):
    papers = spark.createDataFrame([("1", "", [], ["c"], "s https://github.com/a/b"), ("2", "t", ["x"], ["c"], "none"), (None, "", [], ["c"], "s2")],
                                   "id string, title string, authors array<string>, categories array<string>, summary string")
    meta = spark.createDataFrame([("1", "B", ["q"], ["c"], "", "m"), ("1", "A", ["q"], ["c"], "", "m"), (None, "N", ["q"], ["c"], "", "m")],
                                 "id string, title string, authors array<string>, categories array<string>, comment string, summary string")
    out = {r.id: r.title for r in fill.fill_metadata(papers, meta).collect()}
    assert out == {"1": "A", "2": "t", None: ""} and fill.fill_metadata(papers, meta).count() == 3
    stats = spark.createDataFrame([("a", "b", 3, "2026-01-01T0"), ("a", "b", 5, "2026-01-02T0"), (None, None, 9, "x")], "owner string, repo string, stars int, pushed_at string")
    facts = sorted((r.id or "", r.code_url, r.code_stars, r.code_last_update) for r in fill.repo_facts(papers, stats).collect())
    assert facts == [("", None, 0, ""), ("1", "https://github.com/a/b", 5, "2026-01-02"), ("2", None, 0, "")]
    v = papers.select(fill.text_hash("summary").alias("text_hash"), F.lit(False).alias("flagged"))
    v = v.unionByName(v.where("false")).unionByName(v.limit(1).withColumn("flagged", F.lit(True)))
    assert fill.verdict_lookup(papers, v).count() == 3


def test_safety_gate_decides_per_row(spark):
    rows = spark.createDataFrame([(None, "bad"), (None, "good"), ("x", "good"), ("x", "bad"), ("y", None)], "id string, summary string")
    v = rows.where("summary = 'bad'").select(fill.text_hash("summary").alias("text_hash"), F.lit(True).alias("flagged"))
    kept, gone = fill.safety_gate(rows, v, fields=("summary",))
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.where("summary is null or summary = 'good'").collect()))
    assert sorted(str(r.id) for r in gone.collect()) == ["None", "x"]


def test_writes_leave_other_days(spark, tmpdir_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for day in ("2026-01-01", "2026-01-02"):
            lines = spark.createDataFrame([(dt.date.fromisoformat(day), 1, 1, f"line {day}")], "date date, frag_no long, sub long, line string")
            digest.write_digest(lines, f"{tmpdir_path}/digest")
            c = spark.createDataFrame([(day, "1", (True,)), (day, "2", (False,))], "date string, id string, topic_filter struct<relevant:boolean>")
            assert topic.write_split(c, f"{tmpdir_path}/split") == topic.STATUS_OK
        assert spark.read.text(f"{tmpdir_path}/digest").count() == 2
        assert all(topic.read_split(spark, f"{tmpdir_path}/split", name).count() == 2 for name in ("kept", "excluded"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_replayed_batch_keeps_its_rows(spark, tmpdir_path):
    batch = spark.createDataFrame([("a", D, 1), ("b", D, 2), (None, D, 3)], "id string, date date, seq long")
    write = fs.dedup_batch_writer(f"{tmpdir_path}/store", f"{tmpdir_path}/state")
    for _ in range(2):
        write(batch, 0)
        assert sorted(r.seq for r in spark.read.parquet(f"{tmpdir_path}/store").collect()) == [1, 2, 3]
    write(batch.withColumn("date", F.date_add("date", 2)), 1)
    assert spark.read.parquet(f"{tmpdir_path}/store").where("batch = 1").count() == 1      # only the row without an id


def test_second_batch_of_a_day_stands_beside_the_first(spark, tmpdir_path):
    ai = "named_struct('tldr', 't', 'motivation', 'm', 'method', 'm', 'result', 'r', 'conclusion', 'c') as AI"
    one = spark.createDataFrame([("a", D, 1, "T", "s", ["x"], ["cs.CV"])], "id string, date date, seq long, title string, summary string, authors array<string>, categories array<string>").selectExpr("*", ai)
    write = fs.publish_writer(f"{tmpdir_path}/feed", f"{tmpdir_path}/digest", manifest_path=f"{tmpdir_path}/manifest")
    write(one, 0)
    write(one.withColumn("id", F.lit("b")).withColumn("seq", F.lit(2).cast("long")), 1)
    write(one.withColumn("id", F.lit("b")).withColumn("seq", F.lit(2).cast("long")), 1)
    assert sorted(r.id for r in spark.read.parquet(f"{tmpdir_path}/feed").collect()) == ["a", "b"]
    assert sum("### [" in r.value for r in spark.read.text(f"{tmpdir_path}/digest").collect()) == 2
    # The manifest names the day's slice, whatever part files it has.
    assert [r.value for r in spark.read.text(f"{tmpdir_path}/manifest").collect()] == [f"{D:%Y-%m-%d}.jsonl"]
