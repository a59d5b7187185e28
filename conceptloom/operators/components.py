"""Connected components of edge tables, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import HOT_ROWS, cut, hot_keys, salted_lookup


def _star(edges: DataFrame, smallest: DataFrame, hot_rows: int) -> DataFrame:
    return salted_lookup(edges, smallest.select("u", "m"), "u", hot_keys(smallest, "u", "n", hot_rows))


def components(edges: DataFrame, a: str = "a", b: str = "b", hot_rows: int = HOT_ROWS, rounds: int = 100) -> DataFrame:
    """``node``, ``component``: the smallest node of each node's undirected component.

    Null ends are left out, repeated and opposite edges count once, an edge to itself makes a component of one.
    """
    clean = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    nodes = cut(clean.select(F.col("u").alias("node")).union(clean.select("v")).distinct())
    now = cut(clean.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "u")))
        large = cut(_star(both, least, hot_rows).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = _star(large, least, hot_rows).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"not converged after {rounds} rounds")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))
