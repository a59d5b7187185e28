import random

import pytest

from conceptloom.llm.groups import connected_groups, same_verdicts


def brute(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            up[find(a)] = find(b)
    groups = {}
    for x in list(up):
        groups.setdefault(find(x), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"v{rng.randrange(120)}", f"v{rng.randrange(120)}") for _ in range(90)] + [("hub", f"h{i}") for i in range(50)] + [(f"c{i}", f"c{i + 1}") for i in range(60)]
    pairs += [("self", "self"), (None, "lost"), ("lost2", None), ("h1", "hub"), ("h1", "hub")]
    df = spark.createDataFrame([(a, b, 1) for a, b in pairs], "a string, b string, group_id int")
    got = {r["member"]: r["group_id"] for r in connected_groups(df, hot_rows=20).collect()}
    assert got == brute(pairs)


def test_verdicts_and_empty_table(spark):
    df = spark.createDataFrame([("a", "b", " Same\t"), ("c", "d", "not same"), ("e", "f", None)], "a string, b string, relation string")
    assert same_verdicts(df).collect() == [("a", "b")]
    assert connected_groups(df.limit(0)).count() == 0
