import numpy as np

from conceptloom.llm.packing import best_two_fit, pack


def fill(sizes, capacity):
    number, _ = best_two_fit(sizes, capacity)
    return np.bincount(number, weights=sizes)


def test_containers_hold_all_and_never_overflow():
    rng = np.random.default_rng(2)
    for capacity in (10, 2048):
        sizes = rng.integers(1, capacity + 1, 700)
        number, place = best_two_fit(sizes, capacity)
        load = np.bincount(number, weights=sizes)
        assert load.max() <= capacity and load.sum() == sizes.sum()
        assert len({*zip(number.tolist(), place.tolist())}) == len(sizes)
        assert len(load) <= 1.05 * sizes.sum() / capacity + 0.35 * (sizes > capacity / 2).sum() + 1


def test_two_items_replace_one():
    # Greedy puts 6 and 3 in one container and leaves room 1; 6 with 2 and 2 fills it.
    assert fill(np.array([6, 3, 2, 2]), 10).max() == 10


def test_pack_in_groups_with_oversized_and_empty_items(spark):
    rows = [(i, n) for i, n in enumerate([5000, 2048, 1, 0, None, 2047, 300] + [700] * 50)] + [(6, 300), (None, 5)]
    out = pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), group_rows=20).collect()
    load = {}
    for r in out:
        load[r["container_id"]] = load.get(r["container_id"], 0) + r["piece_tokens"]
    assert max(load.values()) <= 2048
    assert sorted(r["piece_tokens"] for r in out if r["doc_id"] == 0) == [904, 2048, 2048]
    assert sum(load.values()) == sum(n for _, n in rows if n)
    assert sum(r["doc_id"] is None for r in out) == 1
    assert sum(r["doc_id"] == 6 for r in out) == 2 and not [r for r in out if r["doc_id"] in (3, 4)]
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0
