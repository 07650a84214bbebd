"""Numbering in buckets: the same as a plain window, however rows are dealt; a
hot group is spread; nothing is written down in between."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import numbering


def _rows(spark, n):
    """A third of all rows in one group; nulls, ties in the leading keys, mixed case."""
    g = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 41 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 17).cast("string")))
    cat = F.element_at(F.array(F.lit("Beta"), F.lit("alpha"), F.lit("beta"), F.lit(None), F.lit("Ärger")), (F.xxhash64("id") % 3 + 3).cast("int"))
    return spark.range(n).select(g.alias("g"), (F.col("id") % 7 == 0).alias("flag"), cat.alias("cat"), F.xxhash64("id").alias("seq"), F.col("id").cast("string").alias("id"))


def order():
    return [~F.col("flag"), F.collate(F.col("cat"), "UNICODE"), F.col("cat"), F.col("seq"), F.col("id")]


@pytest.mark.parametrize("n,buckets", [(0, 4), (5, 4), (6000, 4), (6000, 16)])
def test_equals_a_window(spark, n, buckets):
    df = _rows(spark, n)
    w = Window.partitionBy("g").orderBy(*[c.asc_nulls_first() for c in order()])
    want = sorted(map(tuple, df.select("id", F.row_number().over(w).cast("long"), F.count("*").over(Window.partitionBy("g"))).collect()))
    for parts in (1, 5):
        got = numbering.number_rows(df.repartition(parts), order(), ["g"], name="rank", size_name="n", num_partitions=buckets)
        assert sorted(map(tuple, got.select("id", "rank", "n").collect())) == want
        assert got.columns == [*df.columns, "n", "rank"] or set(got.columns) == {*df.columns, "n", "rank"}


def test_one_group_is_dealt_over_buckets(spark):
    df = _rows(spark, 6000)
    keys = df.select("g", "seq")
    cuts = numbering.bounds(keys, 8)
    assert cuts == numbering.bounds(keys.repartition(7), 8) and len(cuts) == 7
    dealt = keys.withColumn("b", numbering.bucket_of([F.col("g"), F.col("seq")], cuts, [f.dataType for f in keys.schema.fields]))
    sizes = {r.b: r["count"] for r in dealt.groupBy("b").count().collect()}
    assert max(sizes.values()) < 3 * 6000 / 8 and dealt.where("g = 'hot'").select("b").distinct().count() >= 3
    placed = dealt.select("g", "seq", "b").orderBy("g", "seq").collect()
    assert [r.b for r in placed] == sorted(r.b for r in placed)


def test_rows_move_once(spark):
    df = _rows(spark, 6000).withColumn("text", F.repeat("id", 50))
    plan = numbering.number_rows(df, order(), ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan                     # no checkpoint in between
    wide = [line for line in numbering.number_rows(df, order(), ["g"])._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line and "text" in line]
    assert len(wide) <= 1
