from conceptloom.operators import typing as T


def test_structure_types(spark):
    cases = [
        ("ReadyState", "RunningState", "STATE_TRANSITION"), ("Process", "AddressSpace", "HAS_COMPONENT"), ("FileInterface", "OpenCall", "API_MEMBER_OF"), ("FileInterface", "EntryTable", "API_MEMBER_OF"),
        ("ControlBlock", "ProgramCounter", "HAS_FIELD"), ("ControlBlock", "Owner", "HAS_COMPONENT"), ("Buffer", "BoundedBuffer", "IS_A"), ("Buffer", "Ring", "IS_A"), ("PagingSystem", "Fork", "HAS_COMPONENT"),
        ("Lock", "SpinLock", "IS_A"), ("Tree", "Trie", "IS_A"), ("Tree", "Other", "RELATED_TO"), (None, "x", None),
    ]
    edges = spark.createDataFrame([c[:2] for c in cases] + [cases[0][:2]], "parent string, child string")
    concepts = spark.createDataFrame([("Ring", "A kind of buffer.", None), ("Trie", "It is a tree of letters.", ["prefix tree"])], "name string, definition string, aliases array<string>")
    forced = spark.createDataFrame([("Process", "AddressSpace", "HAS_COMPONENT", 0.94)], "parent string, child string, relation string, confidence double")
    categories = spark.createDataFrame([("Buffer",)], "name string")
    rows = T.structure_types(edges, concepts, categories, forced).collect()
    assert {(r["parent"], r["child"], r["relation"]) for r in rows} == {c for c in cases if c[2]} and len(rows) == len(cases) - 1
    assert {r["child"] for r in rows if r["review"]} == {"Other"}


def test_coverage_rules(spark):
    texts = spark.createDataFrame([("The Peterson solution",), ("uses a FLAG array",), (None,)], "text string")
    words = spark.createDataFrame([("a", "peterson"), ("a", "flag"), ("b", "peterson"), ("b", "monitor")], "rule string, keyword string")
    rows = spark.createDataFrame([("a", "TurnVariable"), ("b", "Monitor"), ("c", "No")], "rule string, name string")
    assert [tuple(r) for r in T.coverage_rules(texts, "text", words, rows).collect()] == [("a", "TurnVariable")]
    assert T.coverage_rules(texts.limit(0), "text", words, rows).count() == 0
