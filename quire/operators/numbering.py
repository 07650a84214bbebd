"""Skew-safe dense row numbers within groups.

``row_number() over (partition by g order by k)`` sends a whole group to one
task; a day or a section that holds a third of all rows would then be sorted
by a single task.  Here rows are numbered inside buckets, ranges of ``(g, k)``
that hold about equally many rows, so a hot group is spread over many tasks;
a row's number is its place in its bucket behind the group's earlier buckets.

Bucket bounds are quantiles of a sample of the narrow keys: the rows with the
smallest key hashes, ``SAMPLE`` for each bucket at most, which is a fixed choice
for given data however they are partitioned.  The bounds are literals of the
plan, so every pass over the input puts a row into the same bucket and nothing
has to be written down in between.  The sample and the counts read the key
columns alone; whole rows are shuffled once, by (group, bucket).  The counts
are a table of groups x buckets at most, whose size the engine measures.

The order keys are ascending (negate what should descend, nulls come first)
and must end in a unique tie-breaker, so the result is determined by the data.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets at most, and sampled keys a bucket.
BUCKETS = 64
SAMPLE = 32


def _buckets(df: DataFrame, n: int | None) -> int:
    return min(n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), BUCKETS)


def bounds(keys: DataFrame, n: int) -> list[T.Row]:
    """At most ``n - 1`` ascending keys that cut ``keys`` into about equal parts."""
    by_hash = keys.orderBy(F.xxhash64(*[F.col(c).cast("string") for c in keys.columns])).limit(n * SAMPLE)
    rows = by_hash.orderBy(*keys.columns).collect()
    cuts = [rows[len(rows) * i // n] for i in range(1, n)] if len(rows) >= n * SAMPLE else []
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def _less(keys: list[Column], bound: T.Row, types: list[T.DataType]) -> Column:
    """Is the key below the bound (nulls first)?"""
    out = F.lit(False)
    for key, value, kind in reversed(list(zip(keys, bound, types, strict=True))):
        at = F.lit(value).cast(kind)
        below = F.lit(False) if value is None else key.isNull() | (key < at)
        out = F.coalesce(below, F.lit(False)) | (key.eqNullSafe(at) & out)
    return out


def bucket_of(keys: list[Column], cuts: list[T.Row], types: list[T.DataType], low: int = 0) -> Column:
    """The bucket of a key: a search tree over the bounds, so each row makes
    some log2 of their number of comparisons."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(_less(keys, cuts[mid], types), bucket_of(keys, cuts[:mid], types, low)) \
        .otherwise(bucket_of(keys, cuts[mid + 1:], types, low + mid + 1))


def number_rows(df: DataFrame, order_cols: Sequence[Column], group_cols: Sequence[str] = (),
                name: str = "rank", size_name: str | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column numbering rows of each group in order.

    ``size_name`` optionally adds the group's row count (for ``i / n`` and
    circular neighbours).
    """
    g = list(group_cols)
    names = [f"_k{i}" for i in range(len(g) + len(order_cols))]
    keyed = df.select(*[c.alias(n) for n, c in zip(names, [*map(F.col, g), *order_cols])])
    types = [f.dataType for f in keyed.schema.fields]
    cuts = bounds(keyed, _buckets(df, num_partitions))
    rows = df.withColumn("_bucket", bucket_of([F.col(c) for c in g] + list(order_cols), cuts, types).cast("int"))
    counts = rows.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row a (group, bucket): windows over a group's buckets are small.
    before = Window.partitionBy(*g).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = [F.sum("_cnt").over(Window.partitionBy(*g)).alias(size_name)] if size_name else []
    starts = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_bucket").alias("_b"),
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"), *sizes)
    place = F.row_number().over(Window.partitionBy(*g, "_bucket").orderBy(*[c.asc_nulls_first() for c in order_cols]))
    cond = [F.col("_bucket") == F.col("_b")] + [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(g)]
    out = rows.withColumn("_place", place).join(starts, cond)
    out = out.withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
    return out.drop("_bucket", "_b", "_place", "_before", *[f"_g{i}" for i in range(len(g))])
