"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(r)


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs: (u, v) neighbours of u.  Links every neighbour to the smallest id around u; the
    minimum is combined before the shuffle, and the join back lets Spark split a hot u."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    back = pairs.join(low, "u")
    if large:
        return back.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return back.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id reachable, for every id in an edge.

    Ends when a round changes nothing; the number of rounds grows with the logarithm of the
    longest path, and each round writes its edges to the shared folder."""
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = _signature(now)
    while before[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, True).filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = materialise(_star(down, False).filter("a != b").distinct())
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
