import random
from collections import deque

import pytest

from conceptloom.operators import hierarchy as H
from conceptloom.operators.components import components
from conceptloom.plans import records


def brute(edges):
    below, nodes, held = {}, set(), set()
    for p, c in edges:
        below.setdefault(p, set()).add(c)
        nodes |= {p, c}
        if p != c:
            held.add(c)

    def reach(start):
        seen, queue = {start: 0}, deque([start])
        while queue:
            n = queue.popleft()
            for c in below.get(n, ()):
                if c not in seen:
                    seen[c] = seen[n] + 1
                    queue.append(c)
        return seen

    out = {(n, r, h) for r in nodes - held for n, h in reach(r).items()}
    for n in nodes:
        if any(n in reach(c) for c in below.get(n, ())):
            out.add((n, "CYCLE", -1))
    return out


def frame(spark, edges, layer="x"):
    return spark.createDataFrame([(layer, a, b) for a, b in edges], "layer string, parent string, child string")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [1000, 0])
def test_hops_against_brute_force(spark, seed, limit):
    rng = random.Random(seed)
    edges = {(f"n{rng.randrange(14)}", f"n{rng.randrange(14)}") for _ in range(16)} | {("a", "b"), ("b", "c"), ("z", "z")}
    got = {tuple(r)[1:] for r in H.hierarchy(frame(spark, edges), component_edges=limit).collect()}
    assert got == brute(edges)


def test_descendants_and_back_edges(spark):
    e = frame(spark, {("a", "b"), ("b", "d"), ("a", "c"), ("c", "d"), ("d", "b")})
    below = {(r["node"], r["descendant"]) for r in H.hierarchy(e, "descendants").collect()}
    assert below == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "d"), ("c", "d"), ("c", "b"), ("d", "b")}
    assert [tuple(r)[1:] for r in H.hierarchy(e, "back_edges").collect()] == [("d", "b")]


@pytest.mark.parametrize("form", ["hops", "paths", "descendants", "loops"])
def test_the_same_rows_at_every_size(spark, form):
    """Held by one task, shared by several, and never held by one."""
    edges = set()
    for seed in range(1):
        rng = random.Random(seed)
        names = [f"g{seed} {x}" for x in ("A", "A 1", "A > B", "R", "x", "b", "c", "d", "e")]
        edges |= {(rng.choice(names), rng.choice(names)) for _ in range(9)}
    edges |= {("p", "q"), ("q", "r"), ("r", "p"), ("R", "A"), ("R", "A 1"), ("A", "x"), ("A 1", "x")}
    e = frame(spark, edges)
    results = [sorted(map(tuple, H.hierarchy(e, form, limit, steps).collect())) for limit, steps in ((1000, 10**6), (1000, 5), (0, 10**6))]
    assert results[0] and results[0] == results[1] == results[2]


def test_hops_over_an_edge_that_closes_a_loop(spark):
    # From r the traversal goes a, b, c, v, u first; the short way to v is r, u, v, over an edge back to v.
    edges = {("r", "a"), ("a", "b"), ("b", "c"), ("c", "v"), ("v", "u"), ("r", "u"), ("u", "v"), ("v", "w")}
    assert {tuple(r)[1:] for r in H.hierarchy(frame(spark, edges)).collect()} == brute(edges)


def test_nulls_repeats_and_empty_tables(spark):
    raw = spark.createDataFrame([("a", "b"), ("a", "b"), (None, "c"), ("d", None)], "p string, c string").selectExpr("p", "c", "1 AS hops", "2 AS layer")
    edges = H.layer_edges(raw, "l", "p", "c")
    assert {tuple(r) for r in H.hierarchy(edges).collect()} == {("l", "a", "a", 0), ("l", "b", "a", 1)}
    assert H.hierarchy(edges.limit(0)).count() == 0


def test_components_with_hub_and_chain(spark):
    pairs = [("hub", f"x{i}") for i in range(60)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)] + [("s", "s"), (None, "q")]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a string, b string"), hot_rows=10).collect()))
    assert got["x59"] == "hub" and got["c40"] == "c00" and got["s"] == "s" and "q" not in got


@pytest.mark.parametrize("limit", [1000, 0])
def test_all_paths_of_nodes_with_several_parents(spark, limit):
    e = frame(spark, {("a", "b"), ("b", "d"), ("a", "c"), ("c", "d"), ("d", "e"), ("e", "b"), ("r", "c"), ("e", "e")})
    got = sorted(tuple(r)[1:] for r in H.hierarchy(e, "paths", limit).collect())
    ways = ["a", "a > b", "a > b > d", "a > b > d > e", "a > c", "a > c > d", "a > c > d > e", "a > c > d > e > b", "r", "r > c", "r > c > d", "r > c > d > e", "r > c > d > e > b"]
    assert got == sorted((w.split(" > ")[-1], w[0], w.count(">"), w) for w in ways)


def test_query_gives_every_path(spark, tmp_path):
    frame(spark, {("a", "b"), ("b", "d"), ("a", "c"), ("c", "d")}).selectExpr("parent AS prereq", "child AS target").write.parquet(f"{tmp_path}/prerequisite_edges.parquet")
    frame(spark, {("a", "b")}).select("parent", "child").write.parquet(f"{tmp_path}/subtype_edges.parquet")
    got = {r["path"] for r in records.p5_paths(spark, str(tmp_path)).where("layer = 'prereq' AND node = 'd'").collect()}
    assert got == {"a > b > d", "a > c > d"}


def test_back_edges_mean_the_same_at_every_size(spark):
    ring = {(f"n{i}", f"n{(i + 1) % 5}") for i in range(5)} | {("r", "n3"), ("n2", "n2"), ("n1", "n4"), ("n4", "t")}
    small, large = ({tuple(r)[1:] for r in H.hierarchy(frame(spark, ring), "back_edges", limit).collect()} for limit in (1000, 0))
    assert small == large == {("n4", "n0"), ("n2", "n2")}
