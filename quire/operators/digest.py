"""Category analytics and the daily Markdown digest (A1, A2, A9, O1, O2, W4,
F14, F15, S10, S12).

The digest of one day is: a table of contents with one line per primary
category (with its row count), then per category a section header and the
numbered entries.  Category order is the configured preference list, others
after it, ties by name (Q13).  Numbers run across sections; rows without
complete model fields are skipped and take no number, but are counted in the
section totals (A2 before F15).

At scale the document is never built as one string: it is a table of lines
``(date, frag_no, sub, line)``.  Entries are numbered skew-safely (a day
holding a third of all rows is spread over many tasks); every other position
follows from small per-section aggregates; lines are written
range-partitioned and sorted, so concatenating one day's part files in name
order gives the document (``write_digest``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.papers import abs_url, join_authors, primary_category
from ..functions.text import render
from .numbering import number_rows


def _has_primary() -> Column:
    """F14 on the primary category column."""
    return F.col("primary_category").isNotNull() & (F.col("primary_category") != "")


def with_primary(df: DataFrame) -> DataFrame:
    if "primary_category" in df.columns:
        return df
    return df.withColumn("primary_category", primary_category("categories"))


def category_counts(df: DataFrame, by_date: bool = True) -> DataFrame:
    """A1: rows per primary category, plus per-day and grand totals (rollup).

    ``level`` is 0 for a category row, 1 for a day total, 2 for the grand total.
    """
    df = with_primary(df).where(_has_primary())
    keys = ["date", "primary_category"] if by_date else ["primary_category"]
    r = df.rollup(*keys).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    level = F.when(F.col("_gid") == 0, 0).when(F.col("_gid") == 1, 1).otherwise(2) if by_date \
        else F.when(F.col("_gid") == 0, 0).otherwise(2)
    return r.withColumn("level", level.cast("int")).drop("_gid")


def category_order(df: DataFrame, col: str = "primary_category") -> DataFrame:
    """O1: distinct categories in locale order (ICU root collation), numbered."""
    from pyspark.sql import Window
    cats = df.select(col).distinct()
    w = Window.orderBy(F.collate(F.col(col), "UNICODE"), F.col(col))
    # One row per category: a bounded set, ordered in a single small task.
    return cats.select(col, F.row_number().over(w).cast("long").alias("order"))


def preference_rank(category: Column | str, preference: Sequence[str]) -> Column:
    """O2: index in the configured list; unlisted categories rank after all listed."""
    c = F.col(category) if isinstance(category, str) else category
    pos = F.array_position(F.array(*[F.lit(p) for p in preference]), c) if preference else F.lit(0)
    return F.when(pos > 0, pos - 1).otherwise(F.lit(len(preference))).cast("int")


def languages_per_date(df: DataFrame, col: str = "language") -> DataFrame:
    """Available languages of each date, sorted, comma-joined (bounded per date)."""
    return df.groupBy("date").agg(F.array_join(F.array_sort(F.collect_set(col)), ",").alias("languages"))


def complete_ai() -> Column:
    """a digest entry needs all five model fields."""
    ai = F.col("AI")
    c = ai.isNotNull()
    for f in fixed.AI_FIELDS:
        c = c & ai.getField(f).isNotNull()
    return c


def section_totals(df: DataFrame, preference: Sequence[str] = fixed.DEFAULT_PREFERRED_CATEGORIES) -> DataFrame:
    """A2 + O2: per (date, category) all rows, with the section rank, and
    (where rows have model fields) those of them that become ``entries``."""
    d = with_primary(df).where(_has_primary())
    aggs = [F.count(F.lit(1)).alias("total")] + ([F.count_if(complete_ai()).alias("entries")] if "AI" in df.columns else [])
    t = d.groupBy("date", "primary_category").agg(*aggs)
    return t.withColumn("cat_rank", preference_rank("primary_category", preference))


def digest_entries(df: DataFrame, preference: Sequence[str] = fixed.DEFAULT_PREFERRED_CATEGORIES,
                   num_partitions: int | None = None) -> DataFrame:
    """F15 + W4 + S10: numbered Markdown entries ``(date, primary_category, cat_rank, idx, md)``."""
    d = with_primary(df).where(_has_primary() & complete_ai())
    if "seq" not in d.columns:   # no listing order recorded: order by id within a section
        d = d.withColumn("seq", F.lit(0).cast("long"))
    d = d.withColumn("cat_rank", preference_rank("primary_category", preference))
    order = [F.col("cat_rank"), F.col("primary_category"), F.col("seq"), F.col("id")]
    n = number_rows(d, order, ["date"], name="idx", num_partitions=num_partitions)
    authors = join_authors("authors", fixed.DIGEST_AUTHOR_SEPARATOR) \
        if dict(df.dtypes).get("authors", "").startswith("array") else F.col("authors")
    url = F.col("abs") if "abs" in df.columns else abs_url("id")
    md = render(fixed.DIGEST_ENTRY_TEMPLATE, idx=F.col("idx"), title=F.col("title"), url=url, authors=authors,
                cate=F.col("primary_category"), summary=F.col("summary"),
                **{f: F.col("AI").getField(f) for f in fixed.AI_FIELDS})
    return n.select("date", "primary_category", "cat_rank", "idx", "seq", md.alias("md"))


def digest_fragments(df: DataFrame, preference: Sequence[str] = fixed.DEFAULT_PREFERRED_CATEGORIES,
                     num_partitions: int | None = None) -> DataFrame:
    """Document pieces ``(date, frag_no, text)``, ``frag_no`` = position in the day's document.

    Only the entries need skew-safe numbering (W4, ``idx``).  Every other
    position follows from per-section aggregates, a table with one row per
    (day, category): with ``C`` sections, section ``s`` (1-based, in digest
    order) having ``b`` entries before it, the pieces are numbered
    contents header 1, contents line ``1 + s``, section header
    ``1 + C + s + b``, entry ``1 + C + s + idx``.  Every entry but a
    section's first is prefixed by the blank-line separator.
    """
    from pyspark.sql import Window
    totals = section_totals(df, preference)
    entries = digest_entries(df, preference, num_partitions)
    # One row per (day, category): windows over a day's sections are small.  How
    # many entries a section has, and so its first number, needs no numbering.
    order = Window.partitionBy("date").orderBy("cat_rank", "primary_category")
    secs = (totals.withColumn("_ord", F.row_number().over(order).cast("long"))
            .withColumn("_ncat", F.count(F.lit(1)).over(Window.partitionBy("date")).cast("long"))
            .withColumn("_before", F.coalesce(F.sum("entries").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
            .withColumn("_first", F.col("_before") + 1))
    head = totals.select("date").distinct().select(
        "date", F.lit(1).cast("long").alias("frag_no"), F.lit(fixed.DIGEST_TOC_HEADER).alias("text"))
    toc = secs.select("date", (F.col("_ord") + 1).alias("frag_no"),
                      render(fixed.DIGEST_TOC_LINE, cate=F.col("primary_category"), count=F.col("total")).alias("text"))
    hdr = secs.select("date", (F.col("_ncat") + F.col("_ord") + F.col("_before") + 1).alias("frag_no"),
                      render(fixed.DIGEST_SECTION_HEADER, cate=F.col("primary_category")).alias("text"))
    ent = entries.join(secs.select("date", "primary_category", "_ord", "_ncat", "_first"),
                       ["date", "primary_category"]).select(
        "date", (F.col("_ncat") + F.col("_ord") + F.col("idx") + 1).alias("frag_no"),
        F.when(F.col("idx") == F.col("_first"), F.col("md"))
        .otherwise(F.concat(F.lit(fixed.DIGEST_ENTRY_SEPARATOR), F.col("md"))).alias("text"))
    return head.unionByName(toc).unionByName(hdr).unionByName(ent)


def digest_lines(df: DataFrame, preference: Sequence[str] = fixed.DEFAULT_PREFERRED_CATEGORIES,
                 num_partitions: int | None = None) -> DataFrame:
    """The digest as lines ``(date, frag_no, sub, line)``; ``(frag_no, sub)``
    is the line's position in the day's document.

    Every fragment ends with a newline, so splitting fragments into lines and
    writing each line with a newline, in position order, reproduces the
    document byte for byte.
    """
    fr = digest_fragments(df, preference, num_partitions)
    body = F.expr("substring(text, 1, length(text) - 1)")
    lines = fr.select("date", "frag_no", F.posexplode(F.split(body, "\n", -1)).alias("sub", "line"))
    return lines.select("date", "frag_no", (F.col("sub") + 1).cast("long").alias("sub"), "line")


def write_digest(lines: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Write one text document per date: ``path/date=YYYY-MM-DD/part-*``.

    Range partitioning on ``(date, frag_no, sub)`` plus a sort inside each
    task makes part files ordered: their name order is the line order, and a
    day with many entries is written by many tasks.
    """
    n = num_partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The folder key is derived before sorting, so the sort already provides
    # the ordering the partitioned writer needs and no other sort replaces it.
    keyed = lines.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "frag_no", "sub", "line")
    (keyed.repartitionByRange(n, "date", "frag_no", "sub").sortWithinPartitions("date", "frag_no", "sub")
     .select("date", "line")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").text(path))


def archive_index(dates: DataFrame, folder: str = "data") -> DataFrame:
    """Newest first, one ``[date](folder/date.md)`` per digest, one text.

    Dates are a calendar-bounded set (one per published day), so they are
    gathered into a single row.
    """
    d = dates.select(F.date_format("date", "yyyy-MM-dd").alias("d")).distinct()
    line = render(fixed.ARCHIVE_LINE, date=F.col("d"), url=F.concat(F.lit(folder + "/"), F.col("d"), F.lit(".md")))
    g = d.agg(F.sort_array(F.collect_list(F.struct(F.col("d"), line.alias("l"))), asc=False).alias("_x"))
    return g.select(F.array_join(F.transform("_x", lambda s: s.getField("l")), fixed.ARCHIVE_SEPARATOR).alias("index"))
