"""Connected components and skew-safe link finding.

``components`` alternates large-star and small-star steps over an edge table.
``linked_groups`` turns an inverted index (key, node) into links without ever
emitting all pairs of a key: each round compares a key's members with one
pivot, and members that are already in one component need no comparison.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, compact, free_shuffles, materialize, small


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, component): component is the smallest node
    reachable.  Nodes without an edge are absent.  Each round is written to
    the checkpoint folder; a node with many neighbours is pre-aggregated."""
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct())
    n, state = e.count(), None
    e = compact(e, n)
    while True:
        # Both tables have at most two rows an edge: counted, so a broadcast has a known bound.
        hint = F.broadcast if 2 * n <= BROADCAST_ROWS else (lambda df: df)
        # Large star: every larger neighbour of u is hung onto u's smallest one.
        sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = compact(sym.where("v > u").join(hint(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), n)
        # Small star: u and its smaller neighbours are hung onto the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(hint(low), "u")
        e = materialize(compact(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v")))
                                .where("u <> v").distinct(), 2 * n))
        row = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        n, state = row[0], tuple(row)
    node = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return node.unionByName(node.select(F.col("component").alias("node"), "component").distinct())


def linked_groups(entries: DataFrame, verify: Callable[[DataFrame], DataFrame], pair_filter=None, rounds: int = 2, size: str | None = None) -> DataFrame:
    """entries (key, node, rank, ...) -> edges (a, b) whose components are
    those of all verified pairs that share a key.

    ``verify`` takes candidate pairs (a, b), a being the pivot that many others
    share, and returns those that link;
    ``pair_filter(left, right)`` is a lossless condition on two entries of one
    key (columns prefixed l_ and r_).  In each round the member of lowest
    (rank, node) in every unfinished key is its pivot: all others are compared
    with it, and as all of its pairs are then decided it leaves the key.
    Pairs inside one component are never compared.  What is left after the
    rounds is compared across components by a join (split by the engine where
    a key is large), so no link is lost.  ``size`` names a column whose values
    have a ratio of 0.8 or more in every linked pair: the join is then by key
    and size band, each member meeting its own band and the two beside it.
    """
    spark = entries.sparkSession
    extra = [c for c in entries.columns if c not in ("key", "node")]
    left = compact(entries)
    edges = None
    for i in range(rounds + 1):
        if i < rounds:
            pivot = small(materialize(left.groupBy("key").agg(F.min(F.struct("rank", "node", *[c for c in extra if c != "rank"])).alias("p"))))
        other = [F.col(f"p.{c}").alias(f"l_{c}") for c in ["node", *extra]]
        if i < rounds:
            pairs = left.join(pivot, "key").where("node <> p.node").select(*other, *[F.col(c).alias(f"r_{c}") for c in ["node", *extra]], *([] if i == 0 else ["comp", F.col("p.comp").alias("pcomp")]))
            if i:
                pairs = pairs.where("comp <> pcomp")
        else:
            # Values whose ratio is 0.8 lie one band apart at most (a little wider, for rounding).
            band = F.floor(F.log(F.greatest(F.col(size), F.lit(1))) / math.log(1.26)) if size else F.lit(0).cast("long")
            beside = F.explode(F.array(band - 1, band, band + 1)) if size else band
            r = left.select("key", beside.alias("band"), *[F.col(c).alias(f"r_{c}") for c in ["node", *extra]])
            pairs = (left.select("key", band.alias("band"), *[F.col(c).alias(f"l_{c}") for c in ["node", *extra]])
                     .join(r, ["key", "band"]).where("l_node < r_node and l_comp <> r_comp"))
        if pair_filter is not None:
            pairs = pairs.where(pair_filter)
        pairs = compact(materialize(pairs.select(F.col("l_node").alias("a"), F.col("r_node").alias("b")).distinct()))
        found = compact(materialize(verify(pairs)))
        free_shuffles(spark)
        edges = found if edges is None else edges.unionByName(found)
        if i == rounds:
            break
        comp = materialize(components(edges))
        # A key is finished once its members are of one component.
        cols = [c for c in left.columns if c != "comp"]
        left = (left.select(*cols).join(pivot.select("key", F.col("p.node").alias("_p")), "key").where("node <> _p").drop("_p")
                .join(small(comp), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component"))
        many = left.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("key")
        left = compact(materialize(left.join(small(materialize(many)), "key", "left_semi")))
        extra = [c for c in left.columns if c not in ("key", "node")]
        if left.isEmpty():
            break
    return edges
