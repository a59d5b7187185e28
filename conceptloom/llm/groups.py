"""Problem 4: groups of records linked by pairwise matches, by seed-tree pruning.

Every round, each vertex proposes the smallest vertex of its neighbourhood to all its neighbours. A vertex that
nobody proposes is pruned: it hangs below its smallest proposal in a propagation forest and takes no part in
later rounds. The others are linked with the smallest vertex proposed to them. A vertex left alone is a seed.
When no edge is left, the seeds' identifiers flow down the forest, latest round first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import HOT_ROWS, cut, hot_keys, salted_lookup


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_groups(pairs: DataFrame, a: str = "a", b: str = "b", hot_rows: int = HOT_ROWS, rounds: int = 64) -> DataFrame:
    """``member``, ``group_id``: every value of ``a`` or ``b`` with the smallest value of its group.

    Rows with a null on either side link nothing and are left out; a value paired only with itself is its own
    group; repeated and opposite pairs count once; an empty table gives an empty result. Values compare as
    stored (binary order). All steps are joins and aggregations on vertices; each vertex gathers only minima,
    and joins from edges to vertices spread those with more than ``hot_rows`` edges, so a hub's neighbours never
    meet in one task.
    """
    clean = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    vertices = clean.select(F.col("u").alias("member")).union(clean.select("v")).distinct()
    edges = cut(_both_ways(clean.where("u <> v")).distinct())
    forest: list[DataFrame] = []
    for _ in range(rounds):
        if edges.isEmpty():
            break
        # Smallest vertex of each closed neighbourhood, proposed to all of the neighbourhood.
        smallest = cut(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "u")))
        hubs = hot_keys(smallest, "u", "n", hot_rows)
        proposed = salted_lookup(edges, smallest.select("u", "m"), "u", hubs).select(F.col("v").alias("u"), "m")
        proposals = cut(proposed.union(smallest.select("u", "m")).distinct())
        seen = cut(proposals.groupBy("u").agg(F.min("m").alias("best"), F.count(F.lit(1)).alias("n")))
        # A vertex that proposes itself or is proposed by another stays.
        named = proposals.select(F.col("m").alias("u")).distinct()
        pruned = cut(seen.join(named, "u", "left_anti").select(F.col("u").alias("member"), F.col("best").alias("parent")))
        forest.append(pruned)
        linked = salted_lookup(proposals, seen.select("u", "best"), "u", hot_keys(seen, "u", "n", hot_rows)).where("m <> best").select(F.col("m").alias("u"), F.col("best").alias("v"))
        edges = cut(_both_ways(linked).distinct())
    else:
        raise RuntimeError(f"not converged after {rounds} rounds")
    seeds = vertices
    for step in forest:
        seeds = seeds.join(step.select("member"), "member", "left_anti")
    groups = seeds.select("member", F.col("member").alias("group_id"))
    for step in reversed(forest):  # what hangs below vertices of later rounds or seeds; only new rows are written
        above = groups.select(F.col("member").alias("parent"), "group_id")
        children = cut(step.groupBy("parent").agg(F.count(F.lit(1)).alias("n")))
        below = salted_lookup(step, above, "parent", hot_keys(children, "parent", "n", hot_rows), "inner")
        groups = groups.union(cut(below.select("member", "group_id")))
    return groups


def same_verdicts(decisions: DataFrame) -> DataFrame:
    """Pairs that a decision calls the same, ignoring case and surrounding white space of the verdict."""
    return decisions.where(F.lower(F.regexp_replace("relation", r"(?U)^\s+|\s+$", "")) == "same").select("a", "b")
