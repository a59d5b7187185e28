import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conceptloom.operators import candidates as C
from conceptloom.plans import gate_queries as G


def test_every_concept_is_scored_by_its_names_and_its_own_definition(spark):
    texts = spark.createDataFrame([("k1", "The Lazy Table waits. Dirty pages leave before the tick."), ("k2", "An LT here; dirty greedy readers wait."), ("k3", None)], "chunk_id string, text string")
    registry = spark.createDataFrame(
        [
            ("a", ["Lazy Table", "LT Pool"], "A table that keeps dirty pages."), ("b", ["Eager Table"], "A table that leaves dirty readers now."), ("c", ["Other"], "Dirty pages leave."),
            ("d", ["Fourth"], "Dirty pages leave."), ("e", ["Fifth", "LT here"], None),
        ],
        "concept_id string, names array<string>, short_definition string",
    )
    want = {tuple(r) for r in C.content_scores(texts, "chunk_id", "text", registry).collect()}
    assert {(k, c) for k, c, _ in want} == {("k1", "a"), ("k1", "b"), ("k1", "c"), ("k1", "d"), ("k2", "b"), ("k2", "e")}
    for shard in (1, 100):
        assert {tuple(r) for r in C.best_content(texts, "chunk_id", "text", registry, 24, shard, 1).collect()} == {(k, c, round(s, 6)) for k, c, s in want}
    assert {tuple(r)[:2] for r in C.best_content(texts, "chunk_id", "text", registry, 2).collect()} == {("k1", "a"), ("k1", "c"), ("k2", "b"), ("k2", "e")}
    assert C.best_content(texts.limit(0), "chunk_id", "text", registry, 2).count() == 0 and C.best_content(texts, "chunk_id", "text", registry.limit(0), 2).count() == 0


@pytest.mark.parametrize("name", ["lexical_hits", "candidate_concepts", "diagram_candidates", "audit_evidence"])
def test_registry_queries_equal_their_sql(spark, smallest, name):
    con = duckdb.connect()
    for path in glob.glob(f"{smallest}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(map(str, r)) for r in cursor.fetchall())
    df = G.QUERIES[name](spark, smallest)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(str(r[c]) for c in names) for r in df.collect()) == want


LOCAL = "local_id string, name string, aliases array<string>, section string, definition string, chapter string"
REGISTRY = "concept_id string, canonical_name string, aliases array<string>, short_definition string, sections array<string>, chapter string"


def test_alignment_lets_every_name_of_a_chapter_compete(spark):
    base, words = "alpha beta gamma delta omega zeta kappa theta", "Fast lists keep many small records"
    local = spark.createDataFrame(
        [("L1", base, None, "1.1", words, "c1"), ("L2", base, None, "1.1", words, "c2"), ("L3", "Lazy Tables", ["LT"], "1.1", None, "c1"), ("L4", "Busy Ring", None, None, None, None), ("L5", None, None, None, None, "c1"), ("L6", "Shared Cell", None, "2", words, "c1")], LOCAL
    )
    near = base.replace("theta", "thete")
    registry = spark.createDataFrame(
        [
            # Seven of eight words: sure by itself (L2), but a longer name with the same definition and section passes it (L1).
            ("near1", near, None, None, ["9"], "c1"), ("near2", near, None, None, ["9"], "c2"), ("long1", base + " muon nu", None, words, ["1"], "c1"),
            ("table", "Lazy Table", [None, ""], None, None, "c7"), ("key1", "Shared Cells", None, words, ["2.1"], "c1"), ("key2", "Other", ["Shared Cell"], None, ["3"], "c1"),
        ],
        REGISTRY,
    )
    got = {r["local_id"]: (r["concept_id"], r["method"], round(r["score"], 4)) for r in C.align(local, registry).collect()}
    ratio = round(2 * 44 / 90, 4)
    assert got == {
        "L1": (None, "UNMAPPED", 0.0), "L2": ("near2", "HIGH_CONFIDENCE_FUZZY", ratio), "L3": ("table", "EXACT_NAME_OR_ALIAS", 1.0), "L4": (None, "UNMAPPED", 0.0),
        "L5": (None, "UNMAPPED", 0.0), "L6": ("key1", "EXACT_DISAMBIGUATED", 1.0),
    }


def test_chunks_of_a_hub_are_not_listed_for_each_of_its_pairs(spark):
    named = spark.sql("SELECT 'hub' AS concept_id, concat('k', id) AS chunk_id FROM range(500) UNION ALL SELECT concat('c', id), concat('k', 2 * id) FROM range(500)")
    pairs = spark.sql("SELECT concat('c', id) AS a, 'hub' AS b FROM range(500) UNION ALL SELECT 'c1', 'c2' UNION ALL SELECT 'hub', 'nowhere'")
    assert C.probes(pairs, named).count() == 501
    assert sorted(map(tuple, C.shared_chunks(pairs, named).collect())) == sorted((f"c{i}", "hub", f"k{2 * i}") for i in range(250))


def test_chapter_candidates_equal_their_sql_and_only_known_grams_leave_the_texts(spark, smallest):
    con = duckdb.connect()
    for path in glob.glob(f"{smallest}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    for name in ("chapter_candidates", "pair_context"):
        cursor = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in cursor.description]
        want = sorted(tuple(map(str, r)) for r in cursor.fetchall())
        assert sorted(tuple(str(r[c]) for c in names) for r in entry.queries()[name](spark, smallest).collect()) == want
    index = spark.range(1000).selectExpr("xxhash64(id) AS _gram")
    bits = C._bits(index, 16)
    has = lambda df: C._has(bits, df.toPandas()["_gram"].to_numpy().view("uint64"), 16)
    assert has(index).all() and has(spark.range(1000, 3000).selectExpr("xxhash64(id) AS _gram")).mean() < 0.05


def test_align_report_counts_each_local_name_once(spark, smallest):
    rows = entry.queries()["align_all"](spark, smallest).groupBy("method").count().collect()
    report = {r["method"]: r["n"] for r in entry.queries()["align_report"](spark, smallest).collect()}
    assert report == {r["method"]: r["count"] for r in rows} and sum(report.values()) == G._local(spark, smallest).count()
