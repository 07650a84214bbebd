"""Structured Streaming forms of the daily feed.

* T1 incremental ingest: a file stream over the feed folder; the checkpoint
  remembers which files were processed, so each run (``availableNow``) reads
  only new files, once for both rows and quarantine.
* T2 look-back dedup, exact: every micro-batch is de-duplicated with the
  batch fold (``operators.dedup.backfill_dedup``) seeded with the last kept
  date of each id from a compact table of the look-back's days, so any
  batching of days gives the day-by-day result (days must arrive in order).
  Writes are keyed by ``(date, batch)`` partitions and use dynamic overwrite,
  so a replayed micro-batch replaces its own output instead of duplicating it.
  ``dedup_with_state`` is the same rule as a per-id state machine with timers
  (``transformWithStateInPandas``) for sources delivering one day per trigger;
  ``dedup_approx`` is the watermark-based approximation.
* T3 daily counts: tumbling one-day windows with a watermark, by any key, by
  title keyword, by category.
* T4 per-batch publish: ``foreachBatch`` writing the feed slices, the digest
  lines and the manifest, each idempotent under replay.
"""
from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions import fixed
from ..operators import dedup
from ..sources.feed import path_exists
from ..schema import CORRUPT_COL, PAPER_JSON

JSON_OPTS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def read_lines_stream(spark: SparkSession, path: str, partition_schema: T.StructType | None = None,
                      max_files: int | None = None) -> DataFrame:
    """The files under ``path`` as a stream of non-blank lines (``value``) with
    their ``file`` and the Hive partition columns of ``partition_schema``."""
    text_schema = T.StructType([T.StructField("value", T.StringType())] +
                               (list(partition_schema.fields) if partition_schema else []))
    r = spark.readStream.schema(text_schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(path).where(F.trim("value") != "").withColumn("file", F.col("_metadata.file_path"))


def parse_lines(lines: DataFrame, schema: T.StructType = PAPER_JSON) -> DataFrame:
    """Lines with ``_j``: the parsed record, whose corrupt field tells a bad line."""
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    return lines.withColumn("_j", F.from_json("value", s, JSON_OPTS))


def good_rows(parsed: DataFrame, schema: T.StructType = PAPER_JSON) -> DataFrame:
    keep = [c for c in parsed.columns if c not in ("value", "file", "_j")]
    return parsed.where(F.col(f"_j.{CORRUPT_COL}").isNull()).select(*[F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields], *keep)


def bad_rows(parsed: DataFrame) -> DataFrame:
    keep = [c for c in parsed.columns if c not in ("value", "file", "_j")]
    return parsed.where(F.col(f"_j.{CORRUPT_COL}").isNotNull()).select("file", F.col("value").alias("line"), *keep)


def read_feed_stream(spark: SparkSession, path: str, schema: T.StructType = PAPER_JSON,
                     partition_schema: T.StructType | None = None, max_files: int | None = None,
                     bad_lines: bool = False) -> DataFrame:
    """JSON-lines files under ``path`` as a stream of parsed rows.

    ``partition_schema`` lists Hive partition columns (e.g. ``date``) found in
    the folder names.  With ``bad_lines`` the stream is the quarantine
    instead: the lines that do not parse, with their file (``run_ingest`` has
    both in one pass).
    """
    parsed = parse_lines(read_lines_stream(spark, path, partition_schema, max_files), schema)
    return bad_rows(parsed) if bad_lines else good_rows(parsed, schema)


def replace_batch(rows: DataFrame, batch_id: int, path: str, *parts: str) -> None:
    """Write a micro-batch's rows; a replay replaces what the batch wrote before
    (its folder is ``batch=<id>``) and nothing else."""
    (rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch", *parts).parquet(path))


def ingest_writer(rows_path: str, quarantine_path: str, schema: T.StructType = PAPER_JSON) -> Callable[[DataFrame, int], None]:
    """T1 ``foreachBatch`` body: the batch's lines are read and parsed once and
    go to two sinks under one batch id.  The parsed batch is kept (on disk where
    memory ends) for the second write; what a lost executor kept is parsed
    again from the same files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(batch, schema).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            replace_batch(good_rows(parsed, schema), batch_id, rows_path)
            replace_batch(bad_rows(parsed), batch_id, quarantine_path)
        finally:
            parsed.unpersist()
    return write


def run_ingest(lines: DataFrame, rows_path: str, quarantine_path: str, checkpoint: str, schema: T.StructType = PAPER_JSON) -> StreamingQuery:
    """Take in all files that are new (``read_lines_stream``): rows and bad
    lines to their own folders, each file read once."""
    return (lines.writeStream.foreachBatch(ingest_writer(rows_path, quarantine_path, schema))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _state_versions(spark: SparkSession, state: str) -> list[int]:
    """Batch ids that the state folder has a complete table of."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    made = [int(n.partition("=")[2]) for n in names if n.startswith("batch=")]
    return sorted(v for v in made if path_exists(spark, f"{state}/batch={v}/_SUCCESS"))


def _drop_version(spark: SparkSession, state: str, version: int) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/batch={version}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


STATE = "id string, last_kept date"


def dedup_batch_writer(store: str, state: str, days: int = fixed.LOOKBACK_DAYS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for exact look-back dedup into ``store`` (parquet).

    What a batch must know of the past is one table of (id, last kept date) of
    the look-back's days, in ``state``: each batch reads the version before its
    own and writes its own (a replay reads and writes the same ones), so the
    store is never listed or read back and an id's state ends with its
    look-back.  The two newest versions are kept."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = [v for v in _state_versions(spark, state) if v < batch_id]
        prior = spark.read.schema(STATE).parquet(f"{state}/batch={versions[-1]}") if versions else None
        kept = dedup.backfill_dedup(batch, days, prior)
        parts = [F.lit(batch_id).cast("long").alias("batch")]
        (kept.select("*", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "batch").parquet(store))
        newest = batch.agg(F.max("date")).first()[0]
        seen = dedup.kept_dates(batch, days, prior).select("id", F.col("date").alias("last_kept"))
        if prior is not None:
            seen = seen.unionByName(prior)
        last = seen.groupBy("id").agg(F.max("last_kept").alias("last_kept"))
        if newest is not None:
            last = last.where(F.col("last_kept") >= F.date_sub(F.lit(newest), days))
        last.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        for old in versions[:-1]:
            _drop_version(spark, state, old)
    return write


def run_lookback_dedup(stream: DataFrame, store: str, checkpoint: str, days: int = fixed.LOOKBACK_DAYS,
                       available_now: bool = True, state: str | None = None) -> StreamingQuery:
    """T2 exact: start the de-duplicating stream into ``store`` (its look-back
    table stands beside the stream's own checkpoint unless ``state`` is given)."""
    state = state or f"{checkpoint.rstrip('/')}-state"
    w = stream.writeStream.foreachBatch(dedup_batch_writer(store, state, days)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LookbackProcessor(StatefulProcessor):
    """T2 as a per-id state machine: the state is the last kept date.  A timer
    of event time ends it with its look-back, so it never holds more ids than
    the look-back's days have."""

    def __init__(self, days: int, columns: list[str]):
        self.days, self.columns = days, columns

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_kept", "last_kept date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:                        # null ids are not copies of each other (Q9)
            for pdf in rows:
                yield pdf[self.columns]
            return
        known = self.last.get() if self.last.exists() else None
        before = last = known[0] if known else None
        for pdf in rows:
            pdf = pdf.sort_values("date", kind="stable")
            keep = []
            for d in pdf["date"]:
                if last is None or (d - last).days > self.days:
                    last = d
                keep.append(d == last)
            out = pdf[pd.Series(keep, index=pdf.index)]
            if len(out):
                yield out[self.columns]
        if last is not None and last != before:
            self.last.update((last,))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(self._end(last))

    def _end(self, last) -> int:
        """The millisecond at which a kept day's look-back is over."""
        midnight = datetime.datetime(last.year, last.month, last.day, tzinfo=datetime.timezone.utc)
        return int((midnight.timestamp() + (self.days + 1) * 86400) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedup_with_state(stream: DataFrame, days: int = fixed.LOOKBACK_DAYS, delay: str = "1 day") -> DataFrame:
    """T2 exact for a source that delivers its days in order: rows of an id's
    kept day pass, others are dropped, rows with a null id all pass.

    State is per id, in RocksDB (set ``STATE_STORE``); event time is the row's
    ``date``, and once the watermark (``delay`` behind the newest day) passes the
    end of an id's look-back its timer removes the state."""
    timed = stream.withColumn("_day", F.col("date").cast("timestamp")).withWatermark("_day", delay)
    return timed.groupBy("id").transformWithStateInPandas(
        statefulProcessor=LookbackProcessor(days, stream.columns), outputStructType=stream.schema,
        outputMode="append", timeMode="eventTime")


def dedup_approx(stream: DataFrame, ts_col: str = "ts", days: int = fixed.LOOKBACK_DAYS) -> DataFrame:
    """T2 approximate: drop an id seen within the watermark delay (state lives longer
    than the exact rule's look-back, so fewer rows are kept)."""
    return stream.withWatermark(ts_col, f"{days} days").dropDuplicatesWithinWatermark(["id"])


def daily_counts(stream: DataFrame, key_col: str, ts_col: str = "ts", delay: str = "1 day") -> DataFrame:
    """Rows per (day, key) in tumbling one-day windows.

    In append mode a day is emitted once the watermark passes its end; rows
    later than the watermark are dropped, and the newest days stay open until
    more data arrives.
    """
    if dict(stream.dtypes).get(ts_col) == "timestamp_ntz":   # watermarks need a zoned timestamp
        stream = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    w = stream.withWatermark(ts_col, delay).groupBy(F.window(ts_col, "1 day"), F.col(key_col))
    return w.agg(F.count(F.lit(1)).alias("n")).select(
        F.to_date(F.col("window.start")).alias("date"), key_col, "n")


def counts_writer(store: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for T3 in update mode: each batch's changed counts
    replace its own earlier output, so a replay changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(store))
    return write


def run_daily_counts(stream: DataFrame, key_col: str, store: str, checkpoint: str, ts_col: str = "ts",
                     delay: str = "1 day") -> StreamingQuery:
    """T3 over all that is there (``availableNow``): every day is counted,
    the newest ones too; ``stored_daily_counts`` reads the result."""
    return (daily_counts(stream, key_col, ts_col, delay).writeStream.outputMode("update")
            .foreachBatch(counts_writer(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def keyword_events(papers: DataFrame) -> DataFrame:
    """A stream (or table) of papers -> one row a title and keyword with its
    day as event time: ``(ts, keyword)``."""
    from ..operators import trends
    return trends.title_keywords(papers).select(F.col("date").cast("timestamp").alias("ts"), "keyword")


def run_keyword_trends(papers: DataFrame, store: str, checkpoint: str, delay: str = f"{fixed.LOOKBACK_DAYS + 1} days") -> StreamingQuery:
    """T3 on keywords (A3, A4): titles' terms are exploded into watermarked
    one-day windows; each batch writes the days and terms that changed, and
    ``stored_daily_counts(…, 'keyword')`` has the newest count of each."""
    return run_daily_counts(keyword_events(papers), "keyword", store, checkpoint, "ts", delay)


def run_category_counts(papers: DataFrame, store: str, checkpoint: str, delay: str = f"{fixed.LOOKBACK_DAYS + 1} days") -> StreamingQuery:
    """T3 on primary categories (A1)."""
    rows = papers.where(F.coalesce(F.col("primary_category"), F.lit("")) != "")
    return run_daily_counts(rows.select(F.col("date").cast("timestamp").alias("ts"), "primary_category"), "primary_category", store, checkpoint, "ts", delay)


def stored_daily_counts(spark: SparkSession, store: str, key_col: str) -> DataFrame:
    """(date, key, n): the last count of each day and key (counts only grow)."""
    return spark.read.parquet(store).groupBy("date", key_col).agg(F.max("n").alias("n"))


def publish_writer(feed_path: str, digest_path: str | None = None,
                   preference=fixed.DEFAULT_PREFERRED_CATEGORIES, manifest_path: str | None = None
                   ) -> Callable[[DataFrame, int], None]:
    """T4: ``foreachBatch`` body: feed slices (S8), digest lines (S10) and the
    manifest (S11), replay-safe.

    A slice is one (date, language, batch), so a day's second batch stands
    beside its first and a replay replaces its own; the digests of the batch's
    days are made from everything that is stored for them.
    """
    from ..operators import digest
    from ..sources import feed

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        parts = [c for c in ("date", "language") if c in batch.columns] + ["batch"]
        (batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(feed_path))
        schema = T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])
        stored = spark.read.schema(schema).parquet(feed_path)
        if digest_path and "AI" in batch.columns:
            days = batch.select("date").distinct()
            day_rows = stored.join(days, "date", "left_semi").drop("batch")
            lines = digest.digest_lines(feed.normalize(day_rows) if "primary_category" not in batch.columns
                                        else day_rows, preference)
            digest.write_digest(lines, digest_path)
        if manifest_path:
            feed.write_manifest(feed.list_files(spark, feed_path), manifest_path)
    return write
