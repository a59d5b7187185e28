import random
from datetime import datetime, timedelta

from conceptloom.operators import orphans as O

DAY = datetime(2024, 1, 1)


def tables(spark, rows, parents):
    refs = spark.createDataFrame(rows, "mention_id long, concept_id string, chunk_id string, created_at timestamp, loaded_at timestamp")
    held = spark.createDataFrame(parents, "key string, created_at timestamp, deleted_at timestamp, loaded_at timestamp")
    return O.references(refs, "mentions", "mention_id", {"concept_id": "concept", "chunk_id": "concept"}), O.parents(held, "concept", "key")


def brute(rows, parents):
    out = set()
    for i, a, b, created, _ in rows:
        for name, key in (("concept_id", a), ("chunk_id", b)):
            if key is None:
                continue
            states = [p for p in parents if p[0] == key]
            if not states:
                cause = "missing"
            elif max(states, key=lambda p: p[3])[2] is not None:
                cause = "deleted"
            elif created is not None and min(p[1] for p in states) > created:
                cause = "late"
            else:
                continue
            out.add(("mentions", name, i, cause, created.strftime("%Y-%m") if created else "unknown"))
    return out


def test_replay_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    when = lambda: DAY + timedelta(days=rng.randrange(300), seconds=rng.randrange(80000))
    key = lambda: None if rng.random() < 0.1 else "hot" if rng.random() < 0.35 else f"k{rng.randrange(25)}"
    rows = [(i, key(), key(), None if rng.random() < 0.1 else when(), when()) for i in range(300)]
    rows += rows[:20]
    parents = [(k, when(), when() if rng.random() < 0.4 else None, when()) for k in [f"k{j}" for j in range(15)] + ["hot"] for _ in range(rng.randrange(1, 4))]
    refs, held = tables(spark, rows, parents)
    for periods in (1, 4):
        got = {tuple(r) for r in O.found(O.replay(refs, held, periods, hot_rows=30)).collect()}
        assert got == brute(rows, parents)


def test_arrival_resolves_and_deletion_reopens(spark):
    ledger = O.Ledger(spark)
    refs, none = tables(spark, [(1, "a", None, DAY, DAY)], [])
    ledger.period(refs, none, "1")
    assert [r["cause"] for r in ledger.pending.collect()] == ["missing"]
    later, arrived = tables(spark, [], [("a", DAY, None, DAY + timedelta(1))])
    ledger.period(later, arrived, "2")
    assert ledger.pending.count() == 0
    _, deleted = tables(spark, [], [("a", DAY, DAY + timedelta(2), DAY + timedelta(2))])
    ledger.period(later, deleted, "3")
    assert [r["cause"] for r in ledger.pending.collect()] == ["deleted"]
    assert [s.count() for s in ledger.snapshots] == [1, 0, 1]


def test_empty_tables(spark):
    refs, held = tables(spark, [], [])
    assert O.found(O.replay(refs, held)).count() == 0


def test_ledger_on_a_stream_with_a_restart_a_repeated_batch_and_a_deletion(spark, tmp_path):
    from conceptloom.streaming.ingest import ledger_stream

    schema = "ref_table string, ref_field string, row_id long, pk string, created_at timestamp, loaded_at timestamp, parent struct<pk:string,created_at:timestamp,deleted_at:timestamp,loaded_at:timestamp>"
    ref = lambda i, k: ("m", "c", i, k, DAY, DAY, None)
    parent = lambda k, gone, at: (None, None, None, None, None, None, (k, DAY, gone, DAY + timedelta(at)))
    source, state = f"{tmp_path}/in", f"{tmp_path}/ledger"
    seen = []
    for rows in ([ref(1, "a"), ref(2, "b"), parent("b", None, 0)], [parent("a", None, 1)], [parent("b", DAY, 2), ref(3, "a")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ledger_stream(spark.readStream.schema(schema).parquet(source), O.Ledger(spark, state, buckets=4), f"{tmp_path}/offsets").awaitTermination()
        seen.append(sorted((r["row_id"], r["cause"]) for r in O.Ledger(spark, state, buckets=4).pending.collect()))
    assert seen == [[(1, "missing")], [], [(2, "deleted")]]
    again = O.Ledger(spark, state, buckets=4)
    refs, none = tables(spark, [(9, "zz", None, DAY, DAY)], [])
    again.period(refs, none, "2", 3)
    assert again.done() == 3 and again.pending.count() == 1 and [s.count() for s in again.snapshots] == [1, 0, 1]
