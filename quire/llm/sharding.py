"""Rendezvous hashing of stable record keys over weighted shards (native).

A record's shard is the one with the largest ``-w / ln(u)``, u being a uniform
number from the hash of (key, shard number): only the key, the shard numbers
and the weights decide, so adding a shard moves rows only into the new one.
The law that holds is ``key``.

Slots number the rows of a shard from 0 without a gap.  A shard may hold a
large part of all rows, so it is numbered in ``buckets`` key-hash buckets:
counts of (shard, bucket) are summed first (a table of at most shards x buckets
rows), and a window runs inside each bucket only.

Defined results: a null or empty text has size 8 and the CRC of no bytes; a
null key is hashed as its own key; repeated rows keep one slot each; other
columns are ignored (their names cannot clash); an empty table gives no row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
BUCKETS = 512
_TOP = float(1 << 53)


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard of a key: argmax over shards, ties to the lower number."""
    def score(k: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(k), key), 11).cast("double") + F.lit(0.5)) / F.lit(_TOP)
        return F.struct((F.lit(-float(w)) / F.ln(u)).alias("s"), F.lit(-k).alias("k"))
    if len(weights) == 1:
        return F.lit(0)
    return (-F.greatest(*[score(k, w) for k, w in enumerate(weights)])["k"]).cast("int")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: list[float] | None = None,
          grown_weight: float = 1.0, buckets: int = BUCKETS) -> DataFrame:
    """-> (key, size, text_crc32, law, shard, slot, grown_shard)."""
    weights = weights or [1.0] * SHARDS
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias(key),
        (F.octet_length(body).cast("long") + F.lit(8)).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), [*weights, grown_weight]).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(buckets)).cast("int").alias("_bucket"))
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most shards x buckets rows: a window over a shard's buckets is small, and so is the broadcast.
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(key, "size", "text_crc32")
    return (rows.join(F.broadcast(base), ["shard", "_bucket"])
            .withColumn("slot", F.col("_base") + F.row_number().over(inside) - F.lit(1))
            .select(key, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"))
