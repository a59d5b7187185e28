import math
import time

import numpy as np
import pytest

from conceptloom.llm import neighbours as N


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    base = rng.standard_normal((900, 64))
    near = base[:120] + 0.3 * rng.standard_normal((120, 64))
    copies = np.repeat(base[200:203], 30, axis=0) * 1.0
    scaled = base[210:215] * 7
    return np.concatenate([base, near, copies, scaled]).astype(np.float32)


def frame(spark, x, extra=()):
    rows = [(f"i{k:05d}", [float(v) for v in row], 1) for k, row in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "id string, embedding array<float>, h int")


def truth(x):
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_pairs_against_brute_force(spark, vectors):
    nan, zero = float("nan"), [0.0] * 64
    extra = [("bad1", None, 1), ("bad2", [1.0], 1), ("bad3", [nan] * 64, 1), ("bad4", zero, 1), ("i00001", [float(v) for v in vectors[1]], 1), (None, [1.0] * 64, 1)]
    df = N.usable_vectors(frame(spark, vectors, extra), "id", "k")
    got = {(r["id_a"], r["id_b"]) for r in N.similar_pairs(df, 0.9).collect()}
    s = truth(vectors)
    want = {(f"i{a:05d}", f"i{b:05d}") for a, b in zip(*np.nonzero(np.triu(s, 1) >= 0.9))}
    assert not got - want and len(want - got) <= 0.01 * len(want)
    assert N.similar_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("split,group_rows", [(3, 200_000), (2, 40)])
def test_split_and_tiled_indexes_find_the_same(spark, vectors, split, group_rows):
    df = N.usable_vectors(frame(spark, vectors), "id", "k")
    whole = {(r["h_a"], r["h_b"]) for r in N.similar_classes(df, 0.9, N.Plan(10, 3, 2)).collect()}
    parts = {(r["h_a"], r["h_b"]) for r in N.similar_classes(df, 0.9, N.Plan(10, 3, 2, 1, split, group_rows)).collect()}
    assert whole and whole == parts


@pytest.mark.parametrize("probe", [0, 1, 2])
def test_every_code_within_the_radius_is_retrieved_once(probe):
    rng = np.random.default_rng(3)
    plan = N.Plan(6, 3, probe)
    code = rng.integers(0, 1 << 18, 400).astype(np.uint64)
    h = np.arange(400)
    got = []
    for j in range(3):
        for a, b in N.pairs_in_index(code, h, code, h, True, j, 6, probe, plan, block=50):
            got += [tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())]
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= plan.radius
    assert sorted(got) == sorted((int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1))))


@pytest.mark.parametrize("probe", [1, 2])
def test_pieces_of_a_split_index_retrieve_every_code_once(probe):
    rng = np.random.default_rng(6)
    plan = N.Plan(8, 3, probe, 1, 2)
    code = rng.integers(0, 1 << 24, 600).astype(np.uint64)
    h = np.arange(600)
    got = []
    for j in range(3):
        for piece in range(probe + 1):
            part = (code >> np.uint64(j * 8 + piece * 2)) & np.uint64(3)
            for p in range(4):
                c, n = code[part == p], h[part == p]
                for a, b in N.pairs_in_index(c, n, c, n, True, j, 6, probe, plan, block=50, piece=piece):
                    got += [tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())]
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= plan.radius
    assert sorted(got) == sorted((int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1))))


def test_few_index_rows_are_on_disk_at_once(spark, vectors, monkeypatch):
    df = N.usable_vectors(frame(spark, vectors), "id", "k")
    tiled, sent = N._tiled, []
    monkeypatch.setattr(N, "_tiled", lambda rows, plan: (sent.append(rows.count()), tiled(rows, plan))[1])
    split = {(r["h_a"], r["h_b"]) for r in N.similar_classes(df, 0.9, N.Plan(12, 2, 1, 1, 3)).collect()}
    whole = {(r["h_a"], r["h_b"]) for r in N.similar_classes(df, 0.9, N.Plan(12, 2, 1)).collect()}
    assert split and split == whole
    assert len(sent) > 1 and max(sent) <= 24 * df.select("h").distinct().count()


def test_shuffle_files_go_when_the_checkpoint_stands(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before = shuffled()
    kept = N._kept(spark.range(1000).repartition(4, "id"))
    for _ in range(100):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and kept.count() == 1000


@pytest.mark.parametrize("norm", [0.02, 0.67, 0.85])
def test_recall_does_not_fall_when_vectors_have_a_common_mean(norm):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((8_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    middle = rng.standard_normal(64)
    x += norm / math.sqrt(1 - norm**2) * middle / np.linalg.norm(middle) * (norm > 0.1)
    plan, coders = N.fit({"k": x[4_000:]}, {"k": 20_000}, 0.9)
    u = x[:4_000] / np.linalg.norm(x[:4_000], axis=1, keepdims=True)
    away = rng.standard_normal(u.shape)
    away -= (away * u).sum(axis=1, keepdims=True) * u
    y = 0.905 * u + math.sqrt(1 - 0.905**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    within = np.bitwise_count(coders["k"].codes(u, plan) ^ coders["k"].codes(y, plan)) <= plan.radius
    assert within.any(axis=1).mean() >= 0.99 and coders["k"].found >= 0.999


def test_nearest_recall(spark, vectors):
    df = N.usable_vectors(frame(spark, vectors), "id", "k")
    rows = N.nearest(df, 10).collect()
    s = truth(vectors)
    np.fill_diagonal(s, -2)
    found = {}
    for r in rows:
        found.setdefault(r["id"], []).append((r["rank"], r["neighbour"], r["similarity"]))
    assert all(sorted(x[0] for x in v) == list(range(1, 11)) for v in found.values()) and len(found) == len(vectors)
    hits = 0
    for k in range(len(vectors)):
        least = np.sort(s[k])[-10]
        hits += sum(s[k, int(n[1:])] >= least - 1e-6 for _, n, _ in found[f"i{k:05d}"])
    assert hits / (10 * len(vectors)) >= 0.99


def test_radius_grows_until_queries_are_answered(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 64))
    x = np.repeat(centres, 13, axis=0) + 0.35 * rng.standard_normal((520, 64))  # cosines of about 0.89
    df = N.usable_vectors(frame(spark, x.astype(np.float32)), "id", "k")
    by_index = {(r["id"], r["rank"], r["neighbour"]) for r in N.nearest(df, 10).collect()}
    s = truth(x.astype(np.float32))
    np.fill_diagonal(s, -2)
    hits = sum(s[int(i[1:]), int(n[1:])] >= np.sort(s[int(i[1:])])[-10] - 1e-6 for i, _, n in by_index)
    assert len(by_index) == 5200 and hits >= 0.99 * 5200
