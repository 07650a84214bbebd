"""Look-back de-duplication (J1, U2, U3, A5), first-seen distinct (W1) and the
multi-day backfill fold that reproduces day-by-day runs in one job.

Semantics
---------
* One day ``d``: a row of ``d`` is dropped when its id occurs on any of the
  previous ``days`` days (``[d - days, d - 1]``).  Duplicates *inside* ``d``
  survive; first-seen distinct (W1) removes them later.
* Null ids never match anything (Q9), so they are never dropped here; use
  ``quarantine_null_ids`` to route them aside.
* Backfill: running the single-day rule day after day, against what earlier
  runs *kept*, keeps an id on a date exactly when that date is more than
  ``days`` days after the id's previous kept date (Q3).  That is a fold over
  each id's sorted distinct dates; it is evaluated with the ``aggregate``
  higher-order function after one shuffle on id.  The per-id state is a set of
  dates (bounded by the calendar), never the id's rows, so a hot id costs no
  more than any other; partial aggregation collapses its rows map-side.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def _day(d: str | Column) -> Column:
    return F.lit(d).cast("date") if isinstance(d, str) else d


def lookback_window(feed: DataFrame, run_date: str, days: int = fixed.LOOKBACK_DAYS) -> DataFrame:
    """Rows of the ``days`` days before ``run_date`` (pruned by the date predicate)."""
    d = _day(run_date)
    return feed.where((F.col("date") >= F.date_sub(d, days)) & (F.col("date") <= F.date_sub(d, 1)))


def lookback_ids(feed: DataFrame, run_date: str, days: int = fixed.LOOKBACK_DAYS) -> DataFrame:
    """Distinct ids of the look-back window."""
    return lookback_window(feed, run_date, days).where(F.col("id").isNotNull()).select("id").distinct()


def lookback_antijoin(feed: DataFrame, run_date: str, days: int = fixed.LOOKBACK_DAYS,
                      history: DataFrame | None = None) -> DataFrame:
    """Rows of ``run_date`` whose id is in none of the previous ``days`` days.

    ``history`` defaults to ``feed`` itself (the stored, already de-duplicated
    days).  Left-anti join on id: both sides shuffle on id once, AQE picks a
    broadcast at run time when the id set is small and splits skewed ids.
    """
    today = feed.where(F.col("date") == _day(run_date))
    hist = lookback_ids(history if history is not None else feed, run_date, days)
    return today.join(hist, "id", "left_anti")


def duplicate_ids(feed: DataFrame, run_date: str, days: int = fixed.LOOKBACK_DAYS) -> DataFrame:
    """Distinct ids present today and in the look-back window."""
    today = feed.where((F.col("date") == _day(run_date)) & F.col("id").isNotNull()).select("id").distinct()
    return today.join(lookback_ids(feed, run_date, days), "id", "left_semi")


def dedup_report(feed: DataFrame, run_date: str, days: int = fixed.LOOKBACK_DAYS) -> DataFrame:
    """A5: one row ``today_total, lookback_size, duplicates, removed, remaining, status``.

    One aggregation on id (partial aggregation map-side), then one global
    fold; no join.  Status: ``no_data`` without rows today,
    ``no_new_content`` when every row is a duplicate, else ``has_new_content``
    (``run_status`` adds ``error`` for a feed that cannot be read).
    """
    d = _day(run_date)
    is_today = F.col("date") == d
    in_back = (F.col("date") >= F.date_sub(d, days)) & (F.col("date") <= F.date_sub(d, 1))
    rel = feed.where(is_today | in_back)
    per_id = rel.groupBy("id").agg(
        F.count_if(is_today).alias("n_today"),
        F.max(in_back).alias("in_back"))
    # Null ids form one group here; they never count as seen (Q9).
    seen = F.coalesce(F.col("in_back") & F.col("id").isNotNull(), F.lit(False))
    r = per_id.agg(
        F.coalesce(F.sum("n_today"), F.lit(0)).cast("long").alias("today_total"),
        F.count_if(seen).cast("long").alias("lookback_size"),
        F.count_if(seen & (F.col("n_today") > 0)).cast("long").alias("duplicates"),
        F.coalesce(F.sum(F.when(seen, F.col("n_today"))), F.lit(0)).cast("long").alias("removed"),
        F.coalesce(F.sum(F.when(~seen, F.col("n_today"))), F.lit(0)).cast("long").alias("remaining"),
    )
    status = (F.when(F.col("today_total") == 0, F.lit(fixed.STATUS_NO_DATA))
              .when(F.col("remaining") == 0, F.lit(fixed.STATUS_NO_NEW))
              .otherwise(F.lit(fixed.STATUS_HAS_NEW)))
    return r.withColumn("status", status)


def first_seen(df: DataFrame, key: str = "id", order: str | None = "seq") -> DataFrame:
    """The first row (lowest ``order``, nulls last) of every key.

    Rows of equal order are told apart by a hash of the row, so the choice
    does not depend on the partitioning; rows with a null key are not copies
    of each other and all stay (Q9).  ``min_by`` over a struct of the row has
    map-side partial aggregation: a key holding a third of the table still
    shuffles one row per task.
    """
    others = [c for c in df.columns if c != key]
    tie = F.xxhash64(F.to_json(F.struct(*others)))
    first = F.struct(F.col(order).isNull(), F.col(order), tie) if order else tie
    agg = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*others), first).alias("_row"))
    kept = agg.select(key, *[F.col("_row").getField(c).alias(c) for c in others])
    return kept.select(*df.columns).unionByName(df.where(F.col(key).isNull()))


def kept_dates(feed: DataFrame, days: int = fixed.LOOKBACK_DAYS, prior: DataFrame | None = None) -> DataFrame:
    """Backfill fold: ``(id, date)`` pairs a day-by-day run would keep.

    ``prior`` (``id, last_kept``) seeds the fold with the last kept date of
    each id from earlier runs (the streaming form passes what it stored).
    """
    per_id = (feed.where(F.col("id").isNotNull())
              .groupBy("id").agg(F.array_sort(F.collect_set("date")).alias("_ds")))
    if prior is not None:
        per_id = per_id.join(prior.select("id", F.col("last_kept").alias("_last")), "id", "left")
        last0 = F.col("_last")
    else:
        last0 = F.lit(None).cast("date")
    init = F.struct(F.array().cast("array<date>").alias("kept"), last0.alias("last"))

    def step(acc: Column, x: Column) -> Column:
        keep = acc.getField("last").isNull() | (F.datediff(x, acc.getField("last")) > days)
        return F.when(keep, F.struct(F.array_append(acc.getField("kept"), x).alias("kept"), x.alias("last"))) \
            .otherwise(acc)

    kept = per_id.select("id", F.aggregate("_ds", init, step).getField("kept").alias("_k"))
    return kept.select("id", F.explode("_k").alias("date"))


def backfill_dedup(feed: DataFrame, days: int = fixed.LOOKBACK_DAYS, prior: DataFrame | None = None) -> DataFrame:
    """All rows of the kept ``(id, date)`` pairs, plus rows with a null id (never duplicates).

    Left-semi join on ``(id, date)``; AQE splits a skewed pair.
    """
    kept = feed.where(F.col("id").isNotNull()).join(kept_dates(feed, days, prior), ["id", "date"], "left_semi")
    return kept.unionByName(feed.where(F.col("id").isNull()))


def run_status(read: Callable[[], DataFrame], run_date: str, days: int = fixed.LOOKBACK_DAYS) -> str:
    """A5: the status of a day's run; ``error`` when the feed cannot be read."""
    try:
        return dedup_report(read(), run_date, days).first()["status"]
    except Exception:  # whatever the source raises, the run is reported, not lost
        return fixed.STATUS_ERROR


def quarantine_null_ids(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q9: (rows with an id, rows without one)."""
    return feed.where(F.col("id").isNotNull()), feed.where(F.col("id").isNull())
