"""Problem 5: parent-child rows to full hierarchies.

Connected components are found first. Components up to a size limit are brought together, several to a task,
and walked there by iterative depth-first traversal with node colours; one whose result is large is walked in several
tasks, each from its own share of the starts. Components whose edges do not fit a task never meet in one:
their hops come from frontier joins and their loops from peeling and colour propagation, with the same results.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .components import components

#: Edges of a component that may be held by one task, of a task's small components together, and steps (starts times edges) of a task.
COMPONENT_EDGES, TASK_EDGES, TASK_STEPS = 500_000, 100_000, 20_000_000


def layer_edges(edges: DataFrame, layer: str, parent: str, child: str) -> DataFrame:
    """Distinct ``layer``, ``parent``, ``child`` with both ends given."""
    kept = edges.where(F.col(parent).isNotNull() & F.col(child).isNotNull())
    return kept.select(F.lit(layer).alias("layer"), F.col(parent).alias("parent"), F.col(child).alias("child")).distinct()


class Walk:
    """A graph of one task: roots, strongly connected loops, and shortest ways down."""

    def __init__(self, parents, children):
        self.below: dict = defaultdict(list)
        held, nodes = set(), set()
        for p, c in zip(parents, children):
            self.below[p].append(c)
            nodes.update((p, c))
            if p != c:
                held.add(c)
        for many in self.below.values():
            many.sort()
        self.nodes = sorted(nodes)
        self.roots = [x for x in self.nodes if x not in held]
        self.places: dict | None = None

    def loops(self) -> tuple[set, list]:
        """Nodes on a loop, and the strongly connected parts they form; low marks join the nodes of a loop."""
        number: dict = {}
        low: dict = {}
        stack, on_loop, parts = [], set(), []
        open_nodes: set = set()
        for start in self.nodes:
            if start in number:
                continue
            number[start] = low[start] = len(number)
            stack.append(start)
            open_nodes.add(start)
            walk = [(start, iter(self.below.get(start, ())))]
            while walk:
                node, rest = walk[-1]
                for child in rest:
                    if child == node:
                        on_loop.add(node)
                    elif child not in number:
                        number[child] = low[child] = len(number)
                        stack.append(child)
                        open_nodes.add(child)
                        walk.append((child, iter(self.below.get(child, ()))))
                        break
                    elif child in open_nodes:
                        low[node] = min(low[node], number[child])
                else:
                    walk.pop()
                    if walk:
                        low[walk[-1][0]] = min(low[walk[-1][0]], low[node])
                    if low[node] == number[node]:
                        group = []
                        while True:
                            group.append(stack.pop())
                            open_nodes.discard(group[-1])
                            if group[-1] == node:
                                break
                        if len(group) > 1:
                            on_loop.update(group)
                        if group[0] in on_loop:
                            parts.append(group)
        return on_loop, parts

    def back_edges(self, part):
        """Edges at which depth-first traversal of a strongly connected part, from its smallest name, meets a node still open.

        Colours: a node is white before its visit, grey while open, black when left. A stack stands for the recursion.
        """
        white, start = set(part), min(part)
        grey = {start}
        white.discard(start)
        walk = [(start, iter(self.below.get(start, ())))]
        while walk:
            node, rest = walk[-1]
            for child in rest:
                if child in grey:
                    yield node, child
                elif child in white:
                    white.discard(child)
                    grey.add(child)
                    walk.append((child, iter(self.below.get(child, ()))))
                    break
            else:
                walk.pop()
                grey.discard(node)

    def order(self) -> dict:
        """Place of each node in depth-first traversal of the whole graph: before all it leads to, but for edges that close a loop.

        Colours: a node is white before its visit, grey while open, black when left; the order is that of leaving, reversed.
        """
        seen: set = set()
        left = []
        for start in [*self.roots, *self.nodes]:
            if start in seen:
                continue
            seen.add(start)
            walk = [(start, iter(self.below.get(start, ())))]
            while walk:
                node, rest = walk[-1]
                child = next((c for c in rest if c not in seen), None)
                if child is None:
                    walk.pop()
                    left.append(node)
                else:
                    seen.add(child)
                    walk.append((child, iter(self.below.get(child, ()))))
        return {node: k for k, node in enumerate(reversed(left))}

    def down(self, start) -> dict:
        """Every node reachable from ``start`` with the fewest hops; loops are not followed.

        Nodes pass on their hops in depth-first order, each once where there is no loop; an edge back to an earlier place that
        shortens a way takes its nodes up again.
        """
        if self.places is None:
            self.places = self.order()
        hops = {start: 0}
        queue = [(self.places[start], start)]
        held = {start}
        while queue:
            _, node = heappop(queue)
            held.discard(node)
            far = hops[node] + 1
            for child in self.below.get(node, ()):
                if far < hops.get(child, far + 1):
                    hops[child] = far
                    if child not in held:
                        held.add(child)
                        heappush(queue, (self.places[child], child))
        return hops


def _share(starts, share: int, shares: int):
    return starts if shares == 1 else [x for x in starts if zlib.crc32(x.encode()) % shares == share]


def _hops(walk: Walk, share: int, shares: int):
    for root in _share(walk.roots, share, shares):
        for node, hops in walk.down(root).items():
            yield node, root, hops
    if share == 0:
        for node in walk.loops()[0]:
            yield node, "CYCLE", -1


def _paths(walk: Walk, share: int, shares: int):
    """Every path from a root by depth-first traversal; a node that is open is not entered again, so loops are not followed."""
    for root in _share(walk.roots, share, shares):
        yield root, root, 0, root
        grey, ways = {root}, [(root, root, iter(walk.below.get(root, ())))]
        while ways:
            node, way, rest = ways[-1]
            child = next((c for c in rest if c not in grey), None)
            if child is None:
                ways.pop()
                grey.discard(node)
                continue
            further = f"{way} > {child}"
            yield child, root, len(ways), further
            grey.add(child)
            ways.append((child, further, iter(walk.below.get(child, ()))))


def _descendants(walk: Walk, share: int, shares: int):
    for node in _share(walk.nodes, share, shares):
        for below, hops in walk.down(node).items():
            if below != node:
                yield node, below, hops


def _back_edges(walk: Walk, share: int, shares: int):
    for part in walk.loops()[1]:
        yield from walk.back_edges(part)


def _loops(walk: Walk, share: int, shares: int):
    for part in walk.loops()[1]:
        for node in part:
            yield node, max(part)


_FORMS = {
    "hops": (_hops, "node string, root_name string, hops int"),
    "paths": (_paths, "node string, root_name string, depth int, path string"),
    "descendants": (_descendants, "node string, descendant string, hops int"),
    "back_edges": (_back_edges, "parent string, child string"),
    "loops": (_loops, "node string, loop string"),
}


def _parted(edges: DataFrame, form: str, component_edges: int, task_steps: int) -> tuple[DataFrame, DataFrame, int]:
    """Edges of components that fit a task with their task, share and number of shares; edges of the others, and how many those are.

    The number of shares comes from the starts of a component times its edges, which bounds its result.
    """
    edges = cut(edges)
    mark = F.concat_ws("\u0001", "layer", "parent"), F.concat_ws("\u0001", "layer", "child")
    named = components(edges.select(mark[0].alias("a"), mark[1].alias("b"))).withColumnRenamed("node", "_a")
    placed = cut(edges.withColumn("_a", mark[0]).join(named, "_a").drop("_a"))
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    if form == "descendants":
        starts = sizes.select("component", (F.col("_n") + 1).alias("_starts"))
    elif form in ("back_edges", "loops"):
        starts = sizes.select("component", F.lit(0).alias("_starts"))
    else:
        starts = _roots(placed).join(placed.select("layer", F.col("parent").alias("start"), "component").distinct(), ["layer", "start"]).groupBy("component").agg(F.count(F.lit(1)).alias("_starts"))
    shares = F.greatest(F.lit(1), F.ceil(F.coalesce("_starts", F.lit(0)) * F.col("_n") / task_steps)).cast("int")
    sizes = cut(sizes.join(starts, "component", "left").select("component", "_n", shares.alias("_shares")))
    total, large, wide = sizes.agg(F.sum("_n"), F.count_if(F.col("_n") > component_edges), F.count_if(F.col("_shares") > 1)).first()
    tasks = max(8, -(-(total or 0) // TASK_EDGES))
    sized = placed.join(sizes, "component") if large or wide else placed.withColumn("_n", F.lit(0)).withColumn("_shares", F.lit(1))
    small = sized.where(F.col("_n") <= component_edges).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    # Components of one share are walked several to a task; a share of a wide one has a task of its own.
    task = F.when(F.col("_shares") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.xxhash64("component"))
    small = small.select("layer", "parent", "child", task.alias("_task"), "_share", "_shares")
    return small, sized.where(F.col("_n") > component_edges).select("layer", "parent", "child"), large or 0


def hierarchy(edges: DataFrame, form: str = "hops", component_edges: int = COMPONENT_EDGES, task_steps: int = TASK_STEPS) -> DataFrame:
    """``layer`` and, by ``form``: 'hops' (node, root_name, hops; CYCLE and -1 for nodes on loops), 'paths' (node,
    root_name, depth, path: every path that enters no node twice, with its own depth), 'descendants', 'back_edges',
    'loops' (node, loop: the greatest name of its strongly connected part).

    edges: distinct ``layer``, ``parent``, ``child`` without nulls. A component where every node has another parent has
    no root and so only its loops. Empty tables give empty results. Components above ``component_edges`` give
    the same rows by joins. Rows leave a task in batches, so none holds its whole result.
    """
    make, schema = _FORMS[form]
    small, large, many = _parted(edges, form, component_edges, task_steps)
    names = ["layer"] + [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string()] + [pa.int32() if c.endswith(" int") else pa.string() for c in schema.split(", ")]

    def walk(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents, children = [], []
        for batch in batches:
            parents += batch.column("parent").to_pylist()
            children += batch.column("child").to_pylist()
        layer, share, shares = key[0].as_py(), *(k.as_py() for k in (key[2:] or (pa.scalar(0), pa.scalar(1))))
        rows = make(Walk(parents, children), share, shares)
        while some := list(islice(rows, 50_000)):
            columns = [[layer] * len(some), *zip(*some)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    out = small.groupBy("layer", "_task", "_share", "_shares").applyInArrow(walk, f"layer string, {schema}")
    if not many:
        return out
    large = cut(large)
    if form == "hops":
        loops = large_loops(large).select("layer", "node", F.lit("CYCLE").alias("root_name"), F.lit(-1).alias("hops"))
        more = large_down(large, _roots(large)).select("layer", "node", F.col("start").alias("root_name"), "hops").union(loops)
    elif form == "paths":
        more = large_paths(large, _roots(large)).select("layer", "node", F.col("start").alias("root_name"), "depth", F.array_join("ways", " > ").alias("path"))
    elif form == "loops":
        more = large_loops(large)
    elif form == "descendants":
        nodes = large.select("layer", F.col("parent").alias("start")).union(large.select("layer", "child")).distinct()
        more = large_down(large, nodes).where("node <> start").select("layer", F.col("start").alias("node"), F.col("node").alias("descendant"), "hops")
    else:
        # A traversal of one strongly connected part depends on nothing outside it, so each part goes to a task of its own.
        loops = large_loops(large)
        near = loops.select("layer", F.col("node").alias("parent"), F.col("loop").alias("_l"))
        far = loops.select("layer", F.col("node").alias("child"), F.col("loop").alias("_m"))
        inner = large.join(near, ["layer", "parent"]).join(far, ["layer", "child"]).where("_l = _m").select("layer", "_l", "parent", "child")
        more = inner.groupBy("layer", "_l").applyInArrow(walk, f"layer string, {schema}")
    return out.unionByName(more)


def _roots(edges: DataFrame) -> DataFrame:
    children = edges.where("parent <> child").select("layer", F.col("child").alias("start")).distinct()
    nodes = edges.select("layer", F.col("parent").alias("start")).union(edges.select("layer", "child")).distinct()
    return nodes.join(children, ["layer", "start"], "left_anti")


def large_down(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``layer``, ``start``, ``node``, ``hops`` by frontier joins: one round for each level."""
    frontier = cut(starts.select("layer", "start", F.col("start").alias("node"), F.lit(0).alias("hops")))
    found = frontier
    while not frontier.isEmpty():
        step = frontier.join(edges.withColumnRenamed("parent", "node"), ["layer", "node"]).select("layer", "start", F.col("child").alias("node"), (F.col("hops") + 1).alias("hops")).distinct()
        frontier = cut(step.join(found.select("layer", "start", "node"), ["layer", "start", "node"], "left_anti"))
        found = found.union(frontier)
    return found


def large_paths(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``layer``, ``start``, ``node``, ``depth``, ``ways`` of every path that enters no node twice: one round of joins for each level."""
    frontier = cut(starts.select("layer", "start", F.col("start").alias("node"), F.lit(0).alias("depth"), F.array("start").alias("ways")))
    found = frontier
    while not frontier.isEmpty():
        step = frontier.join(edges.withColumnRenamed("parent", "node"), ["layer", "node"]).where(~F.array_contains("ways", F.col("child")))
        frontier = cut(step.select("layer", "start", F.col("child").alias("node"), (F.col("depth") + 1).alias("depth"), F.array_append("ways", F.col("child")).alias("ways")))
        found = found.union(frontier)
    return found


def large_loops(edges: DataFrame) -> DataFrame:
    """``layer``, ``node``, ``loop`` (a name of the loop's strongly connected part) of nodes on loops.

    Nodes without edges in or out are peeled off until none is left. Then the greatest name that reaches each
    node spreads along the edges as its colour, and from each node that bears its own colour the way back along
    edges of that colour finds one strongly connected part; the rest goes into the next round.
    """
    itself = edges.where("parent = child").select("layer", F.col("parent").alias("node"), F.col("parent").alias("loop")).distinct()
    left = cut(edges.where("parent <> child"))
    found = itself.limit(0)
    while not left.isEmpty():
        while True:
            size = left.count()
            left = left.join(left.select("layer", F.col("child").alias("parent")).distinct(), ["layer", "parent"], "left_semi")
            left = cut(left.join(left.select("layer", F.col("parent").alias("child")).distinct(), ["layer", "child"], "left_semi").select("layer", "parent", "child"))
            if left.count() == size:
                break
        if left.isEmpty():
            break
        colour = cut(left.select("layer", F.col("parent").alias("node"), F.col("parent").alias("colour")).distinct())
        while True:
            sent = left.join(colour.withColumnRenamed("node", "parent"), ["layer", "parent"]).select("layer", F.col("child").alias("node"), "colour")
            new = cut(colour.union(sent).groupBy("layer", "node").agg(F.max("colour").alias("colour")))
            changed = new.join(colour.withColumnRenamed("colour", "old"), ["layer", "node"]).where("colour <> old")
            done = changed.isEmpty()
            colour = new
            if done:
                break
        inner = cut(
            left.join(colour.select("layer", F.col("node").alias("parent"), "colour"), ["layer", "parent"])
            .join(colour.select("layer", F.col("node").alias("child"), F.col("colour").alias("other")), ["layer", "child"])
            .where("colour = other").select("layer", "parent", "child", "colour")
        )
        reached = cut(colour.where("node = colour").select("layer", "node", "colour"))
        frontier = reached
        while not frontier.isEmpty():
            back = frontier.withColumnRenamed("node", "child").join(inner, ["layer", "child", "colour"]).select("layer", F.col("parent").alias("node"), "colour").distinct()
            frontier = cut(back.join(reached, ["layer", "node", "colour"], "left_anti"))
            reached = cut(reached.union(frontier))
        sizes = reached.groupBy("layer", "colour").count().where("count > 1").select("layer", "colour")
        found = cut(found.union(reached.join(sizes, ["layer", "colour"]).select("layer", "node", F.col("colour").alias("loop"))))
        gone = reached.select("layer", "node")
        left = left.join(gone.withColumnRenamed("node", "parent"), ["layer", "parent"], "left_anti")
        left = cut(left.join(gone.withColumnRenamed("node", "child"), ["layer", "child"], "left_anti").select("layer", "parent", "child"))
    return found.union(itself.join(found.select("layer", "node"), ["layer", "node"], "left_anti"))
