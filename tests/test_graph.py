import random

from conceptloom.operators import graph as G


def edges(spark, rows, schema="source string, target string, confidence double"):
    return spark.createDataFrame(rows, schema)


def test_admission_keeps_the_surest_edges_acyclic(spark):
    e = edges(spark, [("a", "b", 0.9), ("b", "c", 0.8), ("c", "a", 0.7), ("x", "y", 0.1), ("y", "x", 0.2)])
    got = {(r["source"], r["target"]): r["admitted"] for r in G.admit_acyclic(e).collect()}
    assert got == {("a", "b"): True, ("b", "c"): True, ("c", "a"): False, ("x", "y"): False, ("y", "x"): True}


def test_direct_edges_against_brute_force(spark):
    rng = random.Random(3)
    rows = sorted({(f"n{a:02d}", f"n{b:02d}") for a, b in ((rng.randrange(12), rng.randrange(12)) for _ in range(30)) if a < b})
    below = {}
    for a, b in rows:
        below.setdefault(a, set()).add(b)

    def reach(x, without):
        seen, stack = set(), [x]
        while stack:
            n = stack.pop()
            for c in below.get(n, ()):
                if (n, c) != without and c not in seen:
                    seen.add(c)
                    stack.append(c)
        return seen

    want = {(a, b) for a, b in rows if b not in reach(a, (a, b))}
    assert {tuple(r) for r in G.direct_edges(edges(spark, rows, "source string, target string")).collect()} == want


def test_cycles_are_broken_at_the_weakest_edge(spark):
    rows = [("a", "b", "PART_OF", 0.9), ("b", "c", "PART_OF", 0.2), ("c", "a", "PART_OF", 0.8), ("c", "d", "PART_OF", 0.1), ("p", "q", "USES", 0.1), ("q", "p", "USES", 0.2)]
    got = {tuple(r) for r in G.break_cycles(edges(spark, rows, "source string, target string, relation string, strength double")).collect()}
    assert got == {("b", "c", "PART_OF")}


def test_chains_and_reachability(spark):
    e = edges(spark, [("a", "b", 0.5), ("b", "c", 0.5), ("z", "c", 1.0)])
    starts = spark.createDataFrame([("c",)], "node string")
    got = {(tuple(r["chain"]), r["confidence"]) for r in G.chains(e, starts, 3).collect()}
    assert got == {(("b", "c"), 0.5), (("z", "c"), 1.0), (("a", "b", "c"), 0.25)}
    pairs = spark.createDataFrame([("a", "c"), ("c", "a")], "source string, target string")
    assert {tuple(r) for r in G.reachable(e, pairs).collect()} == {("a", "c", True), ("c", "a", False)}
    assert {tuple(r) for r in G.reachable(e, pairs, 1).collect()} == {("a", "c", False), ("c", "a", False)}


def test_admission_against_a_search_for_every_edge(spark):
    import random

    rng = random.Random(7)
    pairs = {(f"n{rng.randrange(12)}", f"n{rng.randrange(12)}") for _ in range(50)} | {("a", "b"), ("b", "n0"), (None, "x")}
    rows = [(s, t, round(rng.random(), 1)) for s, t in sorted(pairs, key=str)]
    kept, want = {}, {}
    for s, t, c in sorted((r for r in rows if r[0]), key=lambda r: (-r[2], r[0], r[1])):
        seen, stack = {t}, [t]
        while stack:
            for n in kept.get(stack.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    stack.append(n)
        want[s, t] = s not in seen
        if want[s, t]:
            kept.setdefault(s, set()).add(t)
    got = G.admit_acyclic(spark.createDataFrame(rows, "source string, target string, confidence double"))
    assert {(r["source"], r["target"]): r["admitted"] for r in got.collect()} == want
