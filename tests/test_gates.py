from conceptloom.operators import candidates as C
from conceptloom.operators import gates as K

TEXT = "The page cache is a part of the kernel. A run queue waits on the scheduler. The scheduler causes delay in the run queue."


def registry(spark):
    rows = [("OS_1", ["Page Cache"], None, "A cache of pages.", False), ("OS_2", ["Run Queue"], "OS_3", "A queue.", False), ("OS_3", ["Scheduler"], None, "What plans.", False), ("OS_4", ["Ready State"], None, "A state.", True), ("OS_5", ["Waiting State"], None, "A state.", True)]
    return spark.createDataFrame(rows, "concept_id string, names array<string>, broader_concept_id string, short_definition string, is_state boolean")


def chunks(spark):
    return spark.createDataFrame([("c1", TEXT, 5), ("c2", None, None)], "chunk_id string, text string, excluded_tail_chars int")


def reasons(df, key):
    return {r[key]: r["reason"] for r in df.collect()}


def test_header(spark):
    schema = "schema_version string, validation_status string, new_concept_candidates int, unresolved_local_kps int"
    good = spark.createDataFrame([("kp-first-global-v3.3-reviewed-2", "PASSED", 0, None)], schema)
    bad = spark.createDataFrame([(None, "FAILED", 1, 2)], schema)
    assert K.header_errors(good).count() == 0 and K.header_errors(bad).count() == 4


def test_import_errors_with_nulls_and_repeats(spark):
    c = spark.createDataFrame([("OS_1",), ("OS_2",), ("OS_2",), ("x",)], "concept_id string")
    k = spark.createDataFrame([("c1",), ("c1",)], "chunk_id string")
    m = spark.createDataFrame([(1, "OS_1", "c1"), (2, None, "c9"), (3, "gone", "c1")], "mention_id long, concept_id string, chunk_id string")
    r = spark.createDataFrame([(1, "OS_1", "OS_1", "uses"), (2, "OS_1", None, "USES"), (3, "OS_1", "OS_2", "odd"), (4, "OS_1", "OS_2", "ODD")], "relation_id long, source_concept_id string, target_concept_id string, relation string")
    got = {tuple(x) for x in K.import_errors(c, k, m, r).collect()}
    assert got == {
        ("duplicate concept_id", "OS_2"), ("non-global concept_id", "x"), ("duplicate chunk_id", "c1"), ("dangling mention concept", "2"), ("dangling mention chunk", "2"), ("dangling mention concept", "3"),
        ("self relation", "1"), ("dangling relation endpoint", "2"), ("unsupported relation type", "3"), ("unsupported relation type", "4"), ("duplicate relation", "OS_1 > ODD > OS_2"),
    }
    assert K.import_errors(c.limit(0), k.limit(0), m.limit(0), r.limit(0)).count() == 0


def test_layer_errors(spark):
    q = "The scheduler causes delay in the run queue."
    schema = "source string, target string, relation string, confidence double, chunk_id string, quote string, evidence array<struct<concept_id:string,chunk_id:string,quote:string>>"
    fine = [("OS_2", "c1", q), ("OS_3", "c1", q)]
    rows = [
        ("OS_3", "OS_2", "PREREQUISITE_OF", 0.9, "c1", q, fine), ("OS_2", "OS_3", "PREREQUISITE_OF", 0.9, "c1", q, fine),
        ("OS_1", "OS_1", "USES", float("nan"), "c9", "", None), ("OS_1", "OS_9", "PREREQUISITE_OF", 0.9, "c1", q, [("OS_1", "c1", "not there"), ("OS_9", "c1", q)]),
    ]
    layer = spark.createDataFrame([*rows, rows[0]], schema)
    got = {tuple(x) for x in K.layer_errors(layer, registry(spark), chunks(spark)).collect()}
    assert got == {
        ("duplicate prerequisite", "OS_3 > OS_2"), ("cyclic prerequisite layer", "OS_3 > OS_2"), ("cyclic prerequisite layer", "OS_2 > OS_3"), ("self prerequisite", "OS_1 > OS_1"),
        ("invalid prerequisite relation type", "OS_1 > OS_1"), ("prerequisite confidence below threshold", "OS_1 > OS_1"), ("invalid prerequisite relationship evidence", "OS_1 > OS_1"),
        ("prerequisite lacks evidence for both endpoints", "OS_1 > OS_1"), ("dangling prerequisite endpoint", "OS_1 > OS_9"), ("invalid prerequisite evidence", "OS_1 > OS_9"),
    }
    loose = {tuple(x) for x in K.layer_errors(layer, registry(spark), chunks(spark), in_text=False).collect()}
    assert got - loose == {("invalid prerequisite evidence", "OS_1 > OS_9")}


def test_relation_gate_reasons_flip_and_repeats(spark):
    q = "A run queue waits on the scheduler."
    rows = [
        ("OS_2", "OS_9", "USES", "c1", q, 0.9, "unknown_or_non_candidate_endpoint"), ("OS_2", "OS_2", "USES", "c1", q, 0.9, "self_loop"), ("OS_2", "OS_3", "LIKES", "c1", q, 0.9, "invalid_relation_type"),
        ("OS_2", "OS_3", "USES", "c1", q, 0.5, "below_confidence_threshold"), ("OS_2", "OS_3", "USES", "c2", q, 0.9, "quote_not_found_in_chunk"), ("OS_2", "OS_3", "USES", "c1", None, 0.9, "quote_not_found_in_chunk"),
        ("OS_1", "OS_2", "USES", "c1", q, 0.9, "relation_endpoint_without_same_chunk_evidence"), ("OS_2", "OS_3", "USES", "c1", "is a part of the kernel", 0.9, "relation_quote_lacks_named_endpoint_anchor"),
        ("OS_2", "OS_3", "HAS_SUBTYPE", "c1", q, 0.9, None), ("OS_3", "OS_2", "HAS_SUBTYPE", "c1", q.upper(), 0.95, None), ("OS_3", "OS_2", "CONTRASTED_WITH", "c1", q, 0.9, None),
    ]
    df = spark.createDataFrame([(*r[:6], i) for i, r in enumerate(rows)], "source_concept_id string, target_concept_id string, relation string, chunk_id string, quote string, confidence double, place int")
    shown = spark.createDataFrame([("c1", "OS_2"), ("c1", "OS_3"), ("c2", "OS_2"), ("c2", "OS_3")], "chunk_id string, concept_id string")
    got = {r["place"]: r for r in K.relation_gate(df, registry(spark), chunks(spark), shown).collect()}
    assert [got[i]["reason"] for i in range(len(rows))] == [r[6] for r in rows]
    assert (got[8]["source"], got[8]["target"]) == ("OS_3", "OS_2") and (got[10]["source"], got[10]["target"]) == ("OS_2", "OS_3")
    assert [got[i]["kept"] for i in (0, 8, 9, 10)] == [False, True, False, True]


def test_relation_review_reasons(spark):
    v = "VERIFIED"
    rows = [
        ("OS_1", "OS_2", "USES", None, "", "relation_not_semantically_verified", "USES"), ("OS_1", "OS_2", "PREREQUISITE_OF", v, "", "relation_type_requires_reviewed_layer", "PREREQUISITE_OF"),
        ("OS_1", "OS_3", "CAUSES", v, "it reduces cost", None, "REDUCES"), ("OS_1", "OS_4", "CAUSES", v, "a higher cost", None, "INCREASES"), ("OS_1", "OS_5", "CAUSES", v, "nothing", "cause_quote_lacks_explicit_causal_language", "CAUSES"),
        ("OS_3", "OS_2", "HAS_SUBTYPE", v, "", None, "HAS_SUBTYPE"), ("OS_2", "OS_3", "HAS_SUBTYPE", v, "", "subtype_not_confirmed_by_global_hierarchy", "HAS_SUBTYPE"),
        ("OS_1", "OS_3", "MANAGES", v, "x", "manages_used_without_explicit_management_evidence", "MANAGES"), ("OS_1", "OS_3", "PROVIDES", v, "x", "provides_used_without_explicit_provision_evidence", "PROVIDES"),
        ("OS_1", "OS_3", "ENABLES", v, "x", "enables_used_without_explicit_enablement_evidence", "ENABLES"), ("OS_1", "OS_3", "INCREASES", v, "x", "increases_quote_lacks_explicit_increase_language", "INCREASES"),
        ("OS_4", "OS_5", "TRANSITIONS_TO", v, "From Ready State it moves to Waiting State", None, "TRANSITIONS_TO"), ("OS_4", "OS_3", "TRANSITIONS_TO", v, "Ready State moves to Scheduler", "state_transition_requires_two_explicit_state_nodes_and_transition_evidence", "TRANSITIONS_TO"),
        ("OS_2", "OS_3", "CONTRASTED_WITH", v, "", "contrast_between_category_and_its_subtype", "CONTRASTED_WITH"), ("OS_1", "OS_2", "INVOKES", v, "", None, "INVOKES"), ("OS_1", "OS_2", "USES", v, "", "generic_uses_shadowed_by_specific_relation", "USES"),
        ("OS_4", "OS_1", "CONTAINS", v, "", "reciprocal_directional_relation", "CONTAINS"), ("OS_1", "OS_4", "CONTAINS", v, "", "reciprocal_directional_relation", "CONTAINS"), ("OS_1", "OS_4", "CONTAINS", v, "again", "reciprocal_directional_relation", "CONTAINS"),
        ("OS_2", "OS_1", "USES", v, "", None, "USES"),
    ]
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(rows)], "relation_id int, source string, target string, relation string, status string, quotes string")
    got = {r["relation_id"]: r for r in K.relation_review(df, registry(spark)).collect()}
    assert [(got[i]["reason"], got[i]["final_relation"]) for i in range(len(rows))] == [r[5:] for r in rows]
    assert got[17]["listed"] and not got[18]["listed"] and not got[2]["listed"]


def test_prerequisite_gate_reasons(spark):
    q = "The scheduler causes delay in the run queue."
    both = [("OS_2", "c1", q), ("OS_3", "c1", q)]
    d = "DIRECT_PREREQUISITE"
    rows = [
        (["shared"], None, None, None, None, None, None, None, "not_a_direct_pedagogical_prerequisite"), (["shared"], "verifier_failure", None, None, None, None, None, None, "pedagogical_verifier_failure"),
        (["formal:HAS_SUBTYPE", "formal:USES"], d, "OS_3", "OS_2", 0.9, "c1", q, both, "taxonomy_example_or_contrast_is_not_a_direct_prerequisite"),
        (["formal:CAUSES", "shared"], d, "OS_3", "OS_2", 0.9, "c1", q, both, "causal_or_quantitative_association_is_not_a_direct_prerequisite"), (["formal:CAUSES", "formal:USES"], d, "OS_3", "OS_2", 0.9, "c1", q, both, None),
        (["shared"], d, "OS_3", "OS_3", 0.9, "c1", q, both, "verifier_returned_invalid_endpoint_or_direction"), (["shared"], d, "OS_3", "OS_2", None, "c1", q, both, "pedagogical_confidence_below_threshold"),
        (["shared"], d, "OS_3", "OS_2", 0.9, "c1", "The page cache is a part", both, "missing_validated_relationship_evidence_naming_both_endpoints"), (["shared"], d, "OS_3", "OS_2", 0.9, "c9", q, both, "missing_validated_relationship_evidence_naming_both_endpoints"),
        (["shared"], d, "OS_3", "OS_2", 0.9, "c1", q, both[:1], "missing_validated_evidence_for_both_prerequisite_endpoints"), (["shared"], "direct_prerequisite", "OS_2", "OS_3", 0.9, "c1", q, both, None),
    ]
    candidates = spark.createDataFrame([(i, "OS_2", "OS_3", r[0]) for i, r in enumerate(rows)], "pair_id int, a string, b string, origins array<string>")
    decisions = spark.createDataFrame([(i, *r[1:8]) for i, r in enumerate(rows) if r[1]], "pair_id int, decision string, prerequisite string, dependent string, confidence double, chunk_id string, quote string, evidence array<struct<concept_id:string,chunk_id:string,quote:string>>")
    got = {r["pair_id"]: r for r in K.prerequisite_gate(candidates, decisions, registry(spark), chunks(spark)).collect()}
    assert [got[i]["reason"] for i in range(len(rows))] == [r[8] for r in rows]
    assert got[10]["source"] == "OS_2" and got[5]["source"] is None and got[6]["confidence"] == 0.0


def test_final_report_and_status(spark):
    c = spark.createDataFrame([("a",), ("b",), ("b",)], "concept_id string")
    k = spark.createDataFrame([("1", "x" * 3000, 0), ("2", "It ends with the", 4), ("3", "and so on.", 0), ("4", None, None)], "chunk_id string, text string, excluded_tail_chars int")
    m = spark.createDataFrame([("a", "1"), ("z", "1"), (None, "1")], "concept_id string, chunk_id string")
    r = spark.createDataFrame([("a", "b", "USES"), ("a", "b", "USES"), ("b", "a", "USES"), ("a", "a", "X")], "source string, target string, relation string")
    report = K.final_report(c, k, m, r).cache()
    got = {x["check"]: (x["n"], x["samples"]) for x in report.collect()}
    assert {x: n for x, (n, _) in got.items()} == {
        "duplicate_concept_ids": 1, "dangling_mentions": 2, "invalid_relation_endpoints": 0, "self_loops": 1, "invalid_relation_types": 1, "duplicate_relation_keys": 1,
        "reciprocal_directional_relations": 2, "oversized_chunks": 1, "suspected_incomplete_sentence_chunks": 1, "suspicious_fragment_start_chunks": 1,
    }
    assert got["oversized_chunks"][1] == ["1"]
    none = spark.createDataFrame([], "rule string, key string")
    assert K.final_status(report, none).first()[0] == "FAILED"
    fine = report.where("NOT fatal")
    status = lambda *a, **b: K.final_status(*a, **b).first()[0]
    assert status(fine, none) == "PASSED" and status(fine, none, extraction_errors=1) == "WARN" and status(fine, none, unresolved=1, extraction_errors=1) == "FAILED"
    assert status(fine, none.union(spark.createDataFrame([("self prerequisite", "x")], none.schema))) == "FAILED"


def test_admission_by_names_and_use(spark):
    rows = [("PageCache", 1, 0, 5, 3, 2, "accept"), ("ServerProcess", 9, 9, 9, 9, 9, "reject"), ("thread1", 9, 9, 9, 9, 9, "reject"), ("Figure3", 9, 9, 9, 9, 9, "reject"), ("A" * 40, 9, 9, 9, 9, 9, "reject"), ("PageTable", 0, 0, 1, None, 0, "demote_to_mention"), ("SwapMap", 0, 1, 1, 1, 2, "accept")]
    df = spark.createDataFrame([r[:6] for r in rows], "name string, definitions int, titles int, occurrences int, chunks int, relations int")
    assert {r["name"]: r["verdict"] for r in K.admit_names(df).collect()} == {r[0]: r[6] for r in rows}


def test_recovery_coverage_classes_and_audit(spark):
    missing = registry(spark).where("concept_id IN ('OS_2', 'OS_5')")
    got = [tuple(r) for r in K.recover_evidence(missing, chunks(spark), C.named_concepts(chunks(spark), "chunk_id", "text", missing)).collect()]
    assert got == [("OS_2", "c1", "A run queue waits on the scheduler.", 0.8)]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "concept_id string")
    assert tuple(K.coverage_gap(ids("a", "b", "c"), ids("a", "z")).first()) == (3, 1, 3, 2)
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    said = spark.createDataFrame([("a", True, "core"), ("b", False, "Core"), ("c", True, "odd")], "name string, valid boolean, importance string")
    assert {tuple(r) for r in K.classified(names, said).collect()} == {("a", "Core"), ("b", "rejected"), ("c", "rejected"), ("d", "rejected")}
    items = spark.createDataFrame([(x, "The  run\nqueue waits.") for x in "abcde"], "item string, evidence string")
    answers = spark.createDataFrame([("a", "retype", ["USES"], 0.9, "RUN queue"), ("b", "RETYPE", ["USES", "CAUSES"], 0.9, ""), ("c", "KEEP", ["ODD"], 0.9, "no"), ("d", "KEEP", None, 1.5, ""), ("zz", "KEEP", None, 0.5, "")], "item string, action string, new_relations array<string>, confidence double, quote string")
    got = {r["item"]: tuple(r)[1:] for r in K.audit_decisions(items, answers).collect()}
    assert got == {"a": ("RETYPE", "USES", 0.9, True), "b": ("REVIEW", None, 0.9, False), "c": ("REVIEW", None, 0.9, False), "d": ("REVIEW", None, 0.0, False), "e": ("REVIEW", None, 0.0, False)}


def test_direction_scores(spark):
    c = spark.createDataFrame([("s", "Scheduler", "A kernel part.", "category", "1.2"), ("f", "Fair Scheduler", "A scheduler that is fair.", "thing", "1.10")], "concept_id string, name string, definition string, kind string, section string")
    m = spark.createDataFrame([("s", "1"), ("s", "1"), ("s", "2"), ("f", "1")], "concept_id string, chunk_id string")
    e = spark.createDataFrame([("s", "f", "HAS_SUBTYPE", ["A fair scheduler is a kind of scheduler."]), ("f", "s", "HAS_SUBTYPE", [None]), ("s", "f", "USES", [])], "source string, target string, relation string, quotes array<string>")
    got = {r["source"]: (r["score"], r["kept"]) for r in K.direction_scores(e, c, m).collect()}
    general = 3.0 * (7 - 1)  # a category against a plain thing
    # Quote twice 3; generality; name in name 3; broader name in the narrower definition 2; mentions 1; section 0.5; longer name 0.5.
    assert got["s"] == (6.0 + general + 3 + 2 + 1 + 0.5 + 0.5, True)
    assert got["f"][1] is False and got["f"][0] < 0
