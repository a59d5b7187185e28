"""Graph operators on edge tables: expansion, traversal, paths, acyclicity, and conflict resolution."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .components import components


def both_ways(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Each edge in either direction."""
    return edges.union(edges.select(*(F.col(target).alias(c) if c == source else F.col(source).alias(c) if c == target else F.col(c) for c in edges.columns)))


def expand(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """G1: ``node``, ``dist``, ``score`` (0.5/dist) of nodes within ``hops`` undirected edges of a set of seeds, without the seeds.

    edges: ``source``, ``target``; seeds: ``node``. Each round joins only the frontier; nulls link nothing.
    """
    near = both_ways(edges.select("source", "target")).where("source <> target").distinct()
    frontier = cut(seeds.select("node").where("node IS NOT NULL").distinct().withColumn("dist", F.lit(0)))
    found = frontier
    for k in range(1, hops + 1):
        step = frontier.select(F.col("node").alias("source")).join(near, "source").select(F.col("target").alias("node")).distinct()
        frontier = cut(step.join(found.select("node"), "node", "left_anti").withColumn("dist", F.lit(k)))
        found = found.union(frontier)
    return found.where("dist > 0").withColumn("score", F.lit(0.5) / F.col("dist"))


def walks(edges: DataFrame, starts: DataFrame, depth: int, upstream: bool = False) -> DataFrame:
    """Distinct ``start``, ``node``, ``distance`` along directed edges up to ``depth``; upstream against them.

    On an acyclic layer a walk repeats no edge; on loops a node comes once for each distance.
    """
    here, there = ("target", "source") if upstream else ("source", "target")
    step_edges = edges.select(F.col(here).alias("node"), F.col(there).alias("next")).distinct()
    level = starts.select(F.col("node").alias("start"), "node").where("node IS NOT NULL").distinct()
    out = None
    for k in range(1, depth + 1):
        level = cut(level.join(step_edges, "node").select("start", F.col("next").alias("node")).distinct())
        out = level.withColumn("distance", F.lit(k)) if out is None else out.union(level.withColumn("distance", F.lit(k)))
    return out


def chains(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """Every chain of up to ``depth`` prerequisite edges that ends in a start: ``start``, ``chain`` (first to last), ``depth``, ``confidence`` (product).

    edges: ``source``, ``target``, ``confidence``. No edge is used twice in a chain.
    """
    step = edges.select(F.col("source"), F.col("target").alias("head"), "confidence")
    level = starts.select(F.col("node").alias("start"), F.col("node").alias("head"), F.array("node").alias("chain"), F.lit(1.0).alias("product"), F.array().cast("array<string>").alias("used"))
    out = None
    for k in range(1, depth + 1):
        edge = F.concat_ws("\u0001", "source", "head")
        level = (
            level.join(step, "head").where(~F.array_contains("used", edge))
            .select("start", F.col("source").alias("head2"), F.concat(F.array("source"), "chain").alias("chain"), (F.col("product") * F.col("confidence")).alias("product"), F.concat("used", F.array(edge)).alias("used"))
            .withColumnRenamed("head2", "head").select("start", "head", "chain", "product", "used")
        )
        part = level.select("start", "chain", F.lit(k).alias("depth"), F.col("product").alias("confidence"))
        out = part if out is None else out.union(part)
    return out


def shortest_paths(edges: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    """``a``, ``b``, ``hops``, ``path`` - the shortest undirected path of up to ``most`` edges, the first in name order among equals."""
    near = both_ways(edges.select("source", "target")).where("source <> target").distinct()
    wanted = cut(pairs.select("a", "b").distinct())
    level = wanted.select("a").distinct().select("a", F.col("a").alias("node"), F.col("a").alias("path"), F.lit(0).alias("hops"))
    found = cut(level)
    level = found
    for k in range(1, most + 1):
        step = level.join(near.withColumnRenamed("source", "node"), "node").select("a", F.col("target").alias("node"), F.concat_ws(" - ", "path", "target").alias("path"))
        first = step.groupBy("a", "node").agg(F.min("path").alias("path")).withColumn("hops", F.lit(k))
        level = cut(first.join(found.select("a", "node"), ["a", "node"], "left_anti").select("a", "node", "path", "hops"))
        found = found.union(level)
    return wanted.join(found.withColumnRenamed("node", "b"), ["a", "b"]).where("hops > 0").select("a", "b", "hops", "path")


def reachable(edges: DataFrame, pairs: DataFrame, most: int | None = None) -> DataFrame:
    """``source``, ``target``, ``reaches`` - whether a directed path leads from source to target, of ``most`` edges at most if given."""
    wanted = cut(pairs.select("source", "target").distinct())
    frontier = cut(wanted.select(F.col("source").alias("start"), F.col("source").alias("node")).distinct())
    step_edges = edges.select(F.col("source").alias("node"), F.col("target").alias("next")).distinct()
    found, reached, k = frontier.limit(0), None, 0
    while (most is None or k < most) and not frontier.isEmpty():
        k += 1
        step = frontier.join(step_edges, "node").select("start", F.col("next").alias("node")).distinct()
        frontier = cut(step.join(found, ["start", "node"], "left_anti"))
        found = cut(found.union(frontier))
    reached = found.select(F.col("start").alias("source"), F.col("node").alias("target"), F.lit(True).alias("_r"))
    return wanted.join(reached, ["source", "target"], "left").select("source", "target", F.coalesce("_r", F.lit(False)).alias("reaches"))


def cyclic_core(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges left when nodes without an edge in or out are peeled off again and again; none if the layer is acyclic. rounds: at most so many."""
    left = cut(edges.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL").distinct())
    now = left.count()
    done = 0
    while now and done != rounds:
        before, done = now, done + 1
        left = left.join(left.select(F.col("target").alias("source")).distinct(), "source", "left_semi")
        left = cut(left.join(left.select(F.col("source").alias("target")).distinct(), "target", "left_semi").select("source", "target"))
        now = left.count()
        if now == before:
            break
    return left


def per_component(edges: DataFrame, function, schema: str) -> DataFrame:
    """Apply a function of a pandas frame to each weakly connected component of ``source``, ``target``."""
    named = components(edges.select(F.col("source").alias("a"), F.col("target").alias("b")))
    placed = edges.join(named.withColumnRenamed("node", "source"), "source")
    return placed.groupBy("component").applyInPandas(lambda rows: function(rows.drop(columns="component")), schema)


class Order:
    """A topological order that grows by edges; an edge that would close a loop is refused.

    Only the stretch of the order between the ends of an edge that runs against it is searched and put in order anew.
    """

    def __init__(self, nodes):
        self.place = {node: k for k, node in enumerate(nodes)}
        self.below: dict = defaultdict(list)
        self.above: dict = defaultdict(list)

    def _stretch(self, start, links: dict, inside) -> list:
        seen, stack = {start}, [start]
        while stack:
            for node in links.get(stack.pop(), ()):
                if node not in seen and inside(self.place[node]):
                    seen.add(node)
                    stack.append(node)
        return sorted(seen, key=self.place.get)

    def admit(self, source, target) -> bool:
        low, high = self.place[target], self.place[source]
        if source == target:
            return False
        if low < high:
            after = self._stretch(target, self.below, lambda k: k <= high)
            if after[-1] == source:
                return False
            before = self._stretch(source, self.above, lambda k: k >= low)
            places = sorted(self.place[x] for x in before + after)
            self.place.update(zip(before + after, places))
        self.below[source].append(target)
        self.above[target].append(source)
        return True


def admit_acyclic(edges: DataFrame) -> DataFrame:
    """``source``, ``target``, ``confidence``, ``admitted`` - edges by falling confidence, then names; an edge that would close a loop is refused.

    An edge that is on no way between loops never closes one and is admitted at once. What peeling leaves is decided in
    order, component by component, since a decision depends on earlier ones of its own component only. Edges with a null
    end have no row.
    """
    all_ = edges.select("source", "target", "confidence").where("source IS NOT NULL AND target IS NOT NULL")
    core = cyclic_core(all_, 3)  # what is peeled is sure; a deep layer is not worth a round for each level

    def admit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["confidence", "source", "target"], ascending=[False, True, True], kind="stable")
        order = Order(sorted({*rows["source"], *rows["target"]}))
        return rows.assign(admitted=[order.admit(s, t) for s, t in zip(rows["source"], rows["target"])])[["source", "target", "confidence", "admitted"]]

    free = all_.join(core, ["source", "target"], "left_anti").select("source", "target", "confidence", F.lit(True).alias("admitted"))
    return free.union(per_component(all_.join(core, ["source", "target"], "left_semi"), admit, "source string, target string, confidence double, admitted boolean"))


def direct_edges(edges: DataFrame) -> DataFrame:
    """Edges of an acyclic layer that no longer path replaces; tested against the whole given set.

    A path that replaces an edge begins with another edge of its source. Reached ends spread from there by
    frontier joins until nothing new is found.
    """
    own = cut(edges.select("source", "target").distinct())
    hop = own.select(F.col("source").alias("node"), F.col("target").alias("next"))
    frontier = cut(own.select("source", F.col("target").alias("node")).join(hop, "node").select("source", F.col("next").alias("node")).distinct())
    reached = frontier
    while not frontier.isEmpty():
        step = frontier.join(hop, "node").select("source", F.col("next").alias("node")).distinct()
        frontier = cut(step.join(reached, ["source", "node"], "left_anti"))
        reached = cut(reached.union(frontier))
    return own.join(reached.select("source", F.col("node").alias("target")), ["source", "target"], "left_anti")


def resolve_opposites(edges: DataFrame) -> DataFrame:
    """Of opposite edges of one relation, the one with the greater ``score`` stays; equal scores keep the edge whose source comes first.

    edges: ``source``, ``target``, ``relation``, ``score``; adds ``kept``.
    """
    pair = Window.partitionBy("relation", F.least("source", "target"), F.greatest("source", "target")).orderBy(F.desc("score"), "source", "target")
    return edges.withColumn("kept", F.row_number().over(pair) == 1)


def break_cycles(edges: DataFrame, least_edges: int = 3) -> DataFrame:
    """``source``, ``target``, ``relation`` of edges removed until no loop is left.

    The shortest loop comes first, among equals the first in name order; of its edges the weakest goes (by
    ``strength``, then names). A relation with fewer than ``least_edges`` edges is left alone. Works component by
    component on what remains after peeling, so acyclic parts never meet in a task.
    """
    many = edges.groupBy("relation").count().where(F.col("count") >= least_edges).select("relation")
    kept = cut(edges.join(many, "relation", "left_semi").groupBy("relation", "source", "target").agg(F.max("strength").alias("strength")))
    tagged = kept.select(F.concat_ws("\u0001", "relation", "source").alias("source"), F.concat_ws("\u0001", "relation", "target").alias("target"), "strength")
    core = cyclic_core(tagged).join(tagged, ["source", "target"])

    def cutting(rows: pd.DataFrame) -> pd.DataFrame:
        strength = {(s, t): w for s, t, w in zip(rows["source"], rows["target"], rows["strength"])}
        removed = []
        while True:
            below: dict = defaultdict(list)
            for s, t in sorted(strength):
                below[s].append(t)
            best = None
            for start in sorted(below):
                before, queue, ring = {start: None}, [start], None
                for node in queue:
                    if start in below.get(node, ()):
                        ring = [node]
                        while before[ring[-1]] is not None:
                            ring.append(before[ring[-1]])
                        ring.reverse()
                        break
                    for child in below.get(node, ()):
                        if child not in before:
                            before[child] = node
                            queue.append(child)
                if ring and (best is None or (len(ring), ring) < (len(best), best)):
                    best = ring
            if best is None:
                break
            around = list(zip(best, best[1:] + best[:1]))
            weakest = min(around, key=lambda e: (strength[e], e))
            removed.append(weakest)
            del strength[weakest]
        return pd.DataFrame(removed, columns=["source", "target"])

    out = per_component(core, cutting, "source string, target string")
    part = lambda c, n: F.element_at(F.split(c, "\u0001"), n)
    return out.select(part("source", 2).alias("source"), part("target", 2).alias("target"), part("source", 1).alias("relation"))


def reciprocal(edges: DataFrame) -> DataFrame:
    """Edges of a relation that exist in the opposite direction too."""
    other = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "relation").distinct()
    return edges.join(other, ["source", "target", "relation"], "left_semi")


def shadowed(edges: DataFrame, generic: str, specific: list[str]) -> DataFrame:
    """Edges of a generic relation on pairs that bear a specific one."""
    pairs = edges.where(F.col("relation").isin(specific)).select("source", "target").distinct()
    return edges.where(F.col("relation") == generic).join(pairs, ["source", "target"], "left_semi")


def substitute(edges: DataFrame, names: DataFrame, ends: list[str]) -> DataFrame:
    """Replace names at some columns by their canonical ones, one level deep.

    names: ``alias``, ``canonical`` with one row per alias.
    """
    out = edges
    for end in ends:
        out = out.join(names.select(F.col("alias").alias(end), F.col("canonical").alias("_c")), end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    return out.select(edges.columns)


def merge_nodes(edges: DataFrame, names: DataFrame, keys: list[str], sums: list[str], maxima: list[str]) -> DataFrame:
    """Re-point edges to canonical nodes, drop what now leads to itself, and add or maximise what coincides."""
    moved = substitute(edges, names, ["source", "target"]).where("source <> target")
    return moved.groupBy("source", "target", *keys).agg(*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in maxima))


def collapsed_names(names: DataFrame, name: str = "name") -> DataFrame:
    """``alias``, ``canonical`` for names with one collapsed key: most inner capitals, then longest, then first in order."""
    from ..functions.text import collapsed_key

    capitals = F.length(F.regexp_replace(F.expr(f"substring({name}, 2)"), "[^A-Z]", ""))
    best = F.max_by(name, F.struct(capitals, F.length(name), -F.col("_seq")))
    numbered = names.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_key", collapsed_key(F.col(name)))
    # First in order: the least name gets the greatest -_seq; a rank within the key keeps this parallel.
    ranked = numbered.withColumn("_seq", F.row_number().over(Window.partitionBy("_key").orderBy(name)))
    groups = ranked.groupBy("_key").agg(best.alias("canonical"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return ranked.join(groups, "_key").where(F.col(name) != F.col("canonical")).select(F.col(name).alias("alias"), "canonical")
