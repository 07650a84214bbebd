"""Look-back dedup: single day, report, backfill fold vs a day-by-day run."""
import datetime as dt

from pyspark.sql import functions as F

from quire.operators import dedup

D0 = dt.date(2026, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n - 1)


def feed(spark, rows):
    return spark.createDataFrame([(i, d, s) for i, d, s in rows], "id string, date date, seq long")


def test_daily_id_kept_every_eighth_day(spark):
    f = feed(spark, [("a", day(n), n) for n in range(1, 21)]
             + [("b", day(n), 100 + n) for n in (1, 8, 9)] + [("c", day(5), 200)])
    kept = {(r.id, r.date) for r in dedup.backfill_dedup(f).collect()}
    assert {d for i, d in kept if i == "a"} == {day(1), day(9), day(17)}
    assert {d for i, d in kept if i == "b"} == {day(1), day(9)}
    assert {d for i, d in kept if i == "c"} == {day(5)}


def _day_by_day(rows, days=7):
    """Brute force: run the single-day rule on each day against what was kept."""
    kept = []
    for d in sorted({r[1] for r in rows}):
        seen = {i for i, dd, _ in kept if d - dt.timedelta(days=days) <= dd <= d - dt.timedelta(days=1)}
        kept += [r for r in rows if r[1] == d and (r[0] is None or r[0] not in seen)]
    return sorted(kept, key=lambda r: r[2])


def test_backfill_equals_day_by_day(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice(["x", "y", "z", "w", None]), day(rnd.randint(1, 40)), s) for s in range(400)]
    got = sorted(((r.id, r.date, r.seq) for r in dedup.backfill_dedup(feed(spark, rows)).collect()),
                 key=lambda r: r[2])
    assert got == _day_by_day(rows)


def test_single_day_keeps_inday_duplicates_and_null_ids(spark):
    f = feed(spark, [("a", day(10), 1), ("a", day(10), 2), ("b", day(10), 3), ("b", day(4), 4),
                     (None, day(10), 5), (None, day(9), 6), ("c", day(2), 7), ("c", day(10), 8)])
    out = sorted(r.seq for r in dedup.lookback_antijoin(f, str(day(10))).collect())
    assert out == [1, 2, 5, 8]      # b seen on day 4 (within 7 days); c only on day 2 (outside)


def test_report_status(spark):
    f = feed(spark, [("a", day(10), 1), ("a", day(9), 2), ("b", day(10), 3)])
    r = dedup.dedup_report(f, str(day(10))).collect()[0]
    assert (r.today_total, r.lookback_size, r.duplicates, r.remaining, r.status) == (2, 1, 1, 1, "has_new_content")
    r = dedup.dedup_report(f.where(F.col("id") == "a"), str(day(10))).collect()[0]
    assert r.status == "no_new_content"
    r = dedup.dedup_report(f, str(day(30))).collect()[0]
    assert r.status == "no_data" and r.today_total == 0


def test_result_disjoint_from_lookback(spark):
    f = feed(spark, [(f"k{i % 13}", day(1 + i % 20), i) for i in range(300)])
    d = str(day(15))
    kept = {r.id for r in dedup.lookback_antijoin(f, d).collect()}
    back = {r.id for r in dedup.lookback_ids(f, d).collect()}
    assert not kept & back


def test_first_seen_is_idempotent(spark):
    f = feed(spark, [("a", day(3), 5), ("a", day(1), 9), ("b", day(2), 1)])
    once = dedup.first_seen(f)
    twice = dedup.first_seen(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {r.id: r.seq for r in once.collect()} == {"a": 5, "b": 1}


def test_hot_key_first_seen(spark):
    """One id holding most rows still reduces map-side to one row per task."""
    rows = [("hot", day(1 + i % 30), i) for i in range(3000)] + [(f"k{i}", day(1), 10_000 + i) for i in range(50)]
    out = {r.id: r.seq for r in dedup.first_seen(feed(spark, rows).repartition(8)).collect()}
    assert out["hot"] == 0 and len(out) == 51


def test_first_seen_keeps_null_ids_and_rows_without_order(spark):
    rows = [(None, 1, "a"), (None, 2, "b"), ("x", None, "c"), ("x", None, "d"), ("y", None, "e"), ("y", 5, "f"), ("y", 5, "g")]
    df = spark.createDataFrame(rows, "id string, seq long, v string")
    runs = [sorted(map(str, dedup.first_seen(df.repartition(n)).collect())) for n in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0]) == 4
    got = dedup.first_seen(df).collect()
    assert {r.v for r in got if r.id is None} == {"a", "b"} and [r.seq for r in got if r.id == "y"] == [5]


def test_run_status_of_an_unreadable_feed(spark):
    assert dedup.run_status(lambda: spark.read.parquet("/nowhere/at/all"), "2026-01-10") == "error"
