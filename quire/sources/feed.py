"""Daily feed files: scans (S1-S3, S6, S7), partition discovery (S4), language
variant choice (S5), overwrite sink (S8) and manifest (S11).

Layouts
-------
* ``hive`` (what this package writes): ``root/date=YYYY-MM-DD/language=L/part-*``;
  ``date`` and ``language`` are partition columns, so a predicate on them
  prunes directories before any file is opened.
* ``flat`` (files named ``YYYY-MM-DD_AI_enhanced_<Language>.jsonl`` in one
  folder, as the original tools write them): date and language come from
  the file name of every row (``_metadata.file_name``); only the configured
  languages count.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.papers import coerce_categories
from ..schema import CORRUPT_COL, PAPER_JSON

JSON_READ = {"allowSingleQuotes": "false"}


def read_feed(spark: SparkSession, path: str, schema: T.StructType = PAPER_JSON, mode: str = "tolerant",
              layout: str = "hive", languages: Sequence[str] = fixed.LANGUAGES,
              pattern: str = fixed.ENRICHED_FILE_PATTERN) -> tuple[DataFrame, DataFrame]:
    """Read JSON-lines feed files -> ``(rows, quarantine)``.

    Lines are read as text and parsed with ``from_json`` (blank lines are
    skipped).  ``tolerant``: a bad line goes to the quarantine with its file
    and text, the rest of the file is kept.  ``strict``: any bad line fails
    the job.
    """
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    opts = dict(JSON_READ)
    opts.update({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL} if mode == "tolerant"
                else {"mode": "FAILFAST"})
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    lines = lines.withColumn("_file", F.col("_metadata.file_path"))
    if layout != "hive":
        fname = F.col("_metadata.file_name")
        lines = (lines.withColumn("date", F.try_to_date(F.regexp_extract(fname, pattern, 1)))
                 .withColumn("language", F.nullif(F.regexp_extract(fname, pattern, 2), F.lit("")))
                 .where(F.col("language").isin(*languages)))
    parsed = lines.withColumn("_j", F.from_json("value", s, opts))
    extra = [c for c in parsed.columns if c not in ("value", "_j")]
    bad = parsed.where(F.col(f"_j.{CORRUPT_COL}").isNotNull()).select(*extra, F.col("value").alias("line"))
    good = parsed.where(F.col(f"_j.{CORRUPT_COL}").isNull()).select(
        *[F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields], *extra)
    return good, bad


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of its own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def in_language(papers: DataFrame, preferred: str | None, default: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """S5 on rows: of each date only the chosen language variant (all rows
    where nothing is preferred or no language is known).

    ``listed`` (``slices`` of the feed's listing) tells the variants without a
    look at the rows; the join with the chosen (date, language) pairs then
    prunes a partitioned feed's folders while it runs, so the other variants'
    files are never opened."""
    if preferred is None or "language" not in papers.columns:
        return papers
    if listed is None:
        pos = F.col("listing_pos") if "listing_pos" in papers.columns else F.lit(0)
        listed = papers.groupBy("date", "language").agg(F.min(pos).alias("listing_pos"))
    return papers.join(choose_language(listed, preferred, default or preferred), ["date", "language"], "left_semi")


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file (a day without rows is a file too)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def read_day(spark: SparkSession, path: str, day: str, **kw) -> DataFrame:
    """One day; an absent or empty day is simply zero rows."""
    if not path_exists(spark, path):
        empty = T.StructType([*PAPER_JSON.fields, T.StructField("date", T.DateType())])
        return spark.createDataFrame([], empty)
    good, _ = read_feed(spark, path, **kw)
    return good.where(F.col("date") == F.lit(day).cast("date"))


def date_range(df: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Inclusive on both ends; only dates that exist (``newest_first`` orders them)."""
    r = df.where(F.col("date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    return r


def up_to_newest(requested: DataFrame, available: DataFrame, col: str = "date") -> DataFrame:
    """nothing after the newest available date.

    The newest date is a scalar subquery: computed once, then applied as a
    constant predicate (no join, no single-partition window).
    """
    newest = available.select(F.max(col)).scalar()
    return requested.where(F.col(col) <= newest)


def random_pick(df: DataFrame, seed: int | None = None, key: str = "id") -> DataFrame:
    """One random row: the least hash of (seed, key), the same row for a
    seed however the data are partitioned.  Plans as a top-1 per task and one
    merge, never a full sort."""
    import random
    salt = str(seed if seed is not None else random.getrandbits(63))
    k = F.col(key).cast("string")
    return df.orderBy(F.md5(F.concat(F.lit(salt), F.coalesce(k, F.lit("")))), k).limit(1)


def newest_first(df: DataFrame) -> DataFrame:
    """Dates newest first (a sort for presentation; ``date`` is low-cardinality)."""
    return df.orderBy(F.col("date").desc())


def normalize(df: DataFrame) -> DataFrame:
    """P2 + F14 on a raw feed: categories as a list, primary category, rows
    without any category dropped."""
    c = coerce_categories("categories") if dict(df.dtypes).get("categories") == "string" else F.col("categories")
    out = df.withColumn("categories", c).withColumn("primary_category", F.try_element_at("categories", F.lit(1)))
    return out.where(F.col("primary_category").isNotNull() & (F.col("primary_category") != ""))


def discover(df: DataFrame) -> DataFrame:
    """S4 + A9: available ``(date, languages)`` of a feed, newest first."""
    return (df.groupBy("date").agg(F.array_sort(F.collect_set("language")).alias("languages"))
            .orderBy(F.col("date").desc()))


def discover_names(names: DataFrame, name_col: str = "file_name", pattern: str = fixed.ENRICHED_FILE_PATTERN,
                   languages: Sequence[str] = fixed.LANGUAGES) -> DataFrame:
    """S4 over a file listing (manifest): ``(date, language, listing_pos)`` of matching names.

    ``listing_pos`` is the first position of the pair in the listing (needed by S5).
    """
    m = names.select(F.col("pos"), F.regexp_extract(name_col, pattern, 1).alias("date"),
                     F.regexp_extract(name_col, pattern, 2).alias("language"))
    m = m.where((F.col("date") != "") & F.col("language").isin(*languages))
    return m.groupBy("date", "language").agg(F.min("pos").alias("listing_pos"))


def choose_language(avail: DataFrame, preferred: str = fixed.LIST_PAGE_LANGUAGE,
                    default: str = fixed.LIST_PAGE_LANGUAGE, order_col: str = "listing_pos") -> DataFrame:
    """Per date the preferred language, else the default, else the first listed.

    ``avail`` holds ``(date, language, listing_pos)``; one small row per
    (date, language), so the per-date window is bounded by the number of
    languages.
    """
    rank = F.when(F.col("language") == preferred, 0).when(F.col("language") == default, 1).otherwise(2)
    w = Window.partitionBy("date").orderBy(rank, F.col(order_col), F.col("language"))
    return avail.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("date", "language")


def write_feed(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Replace exactly the (date, language) slices present in ``df``.

    Dynamic partition overwrite: other days and languages stay untouched, and
    a re-run of the same day is idempotent.  The session's own setting is
    neither read nor changed.
    """
    parts = [c for c in ("date", "language") if c in df.columns]
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).format(fmt).save(path)


def _day_folders(spark: SparkSession, path: str, date_from: str | None, date_to: str | None) -> list[str]:
    """The ``date=`` folders of a feed within a range, from one listing of its top folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)]
    days = [n for n in names if n.startswith("date=") and (date_from or "") <= n[len("date="):] <= (date_to or "9999")]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(days)]


def list_files(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The files of a feed folder, told from its listing alone: ``file_name`` and
    the folder keys (``date``, ``language``) where the layout has them.

    No file is opened and an empty file is a file: the names come from the
    engine's file index, which lists folders in parallel where they are many (a
    scan, even one of file metadata, passes over empty files).  A date range
    leaves out the folders of other days before they are listed."""
    ranged = date_from is not None or date_to is not None
    roots = _day_folders(spark, path, date_from, date_to) if ranged else [path]
    names = spark.read.format("binaryFile").option("basePath", path).load(roots).inputFiles() if roots else []
    files = spark.createDataFrame([(n,) for n in names], "path string")
    # Listed paths are percent-encoded; a plus sign in them is itself.
    told = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    keys = ["date", "language"] if ranged or any("/date=" in n for n in names) else []
    values = [F.nullif(F.regexp_extract(told, f"/{k}=([^/]+)/", 1), F.lit("")) for k in keys]
    return files.select(F.substring_index(told, "/", -1).alias("file_name"),
                        *[(F.try_to_date(v) if k == "date" else F.url_decode(v)).alias(k) for k, v in zip(keys, values)])


def slices(files: DataFrame, pattern: str = fixed.ENRICHED_FILE_PATTERN, languages: Sequence[str] | None = None) -> DataFrame:
    """The ``(date, language)`` slices behind a file listing with
    ``listing_pos``, the name by which the slice is placed in the sorted listing.

    Folder keys tell a slice where the layout has them, else the file's name
    does (``languages`` are then the ones that count); contents never do, so an
    empty file makes its slice available."""
    if "date" in files.columns:
        found = files.select("date", "language")
        name = slice_name("date", "language")
    else:
        wanted = list(languages or fixed.LANGUAGES)
        found = files.select(F.try_to_date(F.regexp_extract("file_name", pattern, 1)).alias("date"),
                             F.regexp_extract("file_name", pattern, 2).alias("language"))
        found = found.where(F.col("date").isNotNull())
        languages, name = wanted, slice_name("date", "language")
    if languages is not None:
        found = found.where(F.col("language").isin(*languages))
    return found.where(F.col("language").isNotNull()).distinct().select("date", "language", name.alias("listing_pos"))


def slice_name(date: str, language: str) -> Column:
    """The bare file name of a slice, as listings have it."""
    return F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(fixed.ENRICHED_FILE_MIDDLE), F.col(language), F.lit(fixed.FEED_FILE_SUFFIX))


def available(spark: SparkSession, path: str, **kw) -> DataFrame:
    """S4 + A9: ``(date, languages)`` of a feed folder by its listing, newest first."""
    return discover(slices(list_files(spark, path), **kw))


def manifest(files: DataFrame) -> DataFrame:
    """Sorted bare names of a feed's data files.

    A flat folder's files are named one by one; a partitioned feed's slices are
    named as the one file that each stands for, whatever part files it has."""
    if "date" in files.columns:
        day = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(fixed.FEED_FILE_SUFFIX))
        names = files.select(F.coalesce(slice_name("date", "language"), day).alias("file")).where(F.col("file").isNotNull())
    else:
        names = files.where(F.col("file_name").endswith(fixed.FEED_FILE_SUFFIX)).select(F.col("file_name").alias("file"))
    return names.distinct().orderBy("file")


def write_manifest(files: DataFrame, path: str) -> None:
    """S11 as one sorted text (a row a data file: a calendar-bounded list)."""
    manifest(files).coalesce(1).sortWithinPartitions("file").write.mode("overwrite").text(path)
