"""Gates in front of the graph: ordered reasons for review, reports on what is left, the overall status, and recovery.

Every gate is a column pipeline: side tables are met by key, each rule becomes a flag, and the first flag that holds is
the reason. Texts are met once and reduced to a flag at once, before any join on a key that may be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import graph as G
from .validate import PREREQUISITE_FLOOR, RELATION_FLOOR, RELATIONS, SYMMETRIC, first_reason

DIRECTIONAL = [r for r in RELATIONS if r not in SYMMETRIC]
# Beginnings of the versions of a document that may be imported.
VERSIONS = [
    "kp-first-global-v3.2-reviewed",
    "kp-first-global-v3.3-reviewed",
    "kp-first-global-v3.4-all-global-candidate-scope-v1",
    "kp-first-global-v3.5-verified-pedagogical-prerequisites-v1",
    "kp-first-global-v3.6-import-contract-preflight-v1",
]
# Kinds of relation that speak against a prerequisite: any of the first, or nothing but the second.
NO_PREREQUISITE = ["formal:HAS_SUBTYPE", "formal:EXAMPLE_OF", "formal:CONTRASTED_WITH"]
ONLY_CAUSAL = ["formal:CAUSES", "formal:INCREASES", "formal:REDUCES"]
RECOVERED_CONFIDENCE, SAMPLES = 0.80, 20


def _flag(rows: DataFrame, keys: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with a flag whether a column's key is in a table of one column; null keys are not."""
    known = keys.toDF(column).where(F.col(column).isNotNull()).distinct().withColumn(name, F.lit(True))
    return rows.join(known, column, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _told(rows: DataFrame, rules: list[tuple[str, Column]], key: Column) -> DataFrame:
    """``rule``, ``key`` for every rule that holds of a row; one pass over the rows."""
    each = F.array(*(F.when(F.coalesce(condition, F.lit(False)), F.lit(rule)) for rule, condition in rules))
    return rows.select(F.explode(F.array_compact(each)).alias("rule"), F.coalesce(key.cast("string"), F.lit("")).alias("key"))


def _repeated(rows: DataFrame, keys: list[Column], rule: str) -> DataFrame:
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    twice = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.select(F.lit(rule).alias("rule"), F.concat_ws(" > ", *(f"_k{i}" for i in range(len(keys)))).alias("key"))


def header_errors(header: DataFrame) -> DataFrame:
    """K1: ``rule``, ``key`` of a document's header.

    header: ``schema_version``, ``validation_status``, ``new_concept_candidates``, ``unresolved_local_kps``; nulls count as missing.
    """
    version = F.coalesce("schema_version", F.lit(""))
    fits = F.exists(F.array(*map(F.lit, VERSIONS)), lambda v: version.startswith(v))
    rules = [
        ("unsupported schema_version", ~fits),
        ("validation_status is not PASSED", F.coalesce("validation_status", F.lit("")) != "PASSED"),
        ("new concept candidates remain", F.col("new_concept_candidates") != 0),
        ("unresolved local KPs remain", F.col("unresolved_local_kps") != 0),
    ]
    return _told(header, rules, F.lit("document"))


def import_errors(concepts: DataFrame, chunks: DataFrame, mentions: DataFrame, relations: DataFrame, prefix: str = "OS_") -> DataFrame:
    """K1: distinct ``rule``, ``key`` of everything in the main tables that an import must not hold.

    concepts: ``concept_id``; chunks: ``chunk_id``; mentions: ``mention_id`` and both keys; relations: ``relation_id``, ends,
    ``relation``. Null keys dangle. Mentions and relations are read once for all their rules.
    """
    c, k = concepts.select("concept_id").distinct(), chunks.select("chunk_id").distinct()
    m = _flag(_flag(mentions.select("mention_id", "concept_id", "chunk_id"), c, "concept_id", "_c"), k, "chunk_id", "_k")
    ends = relations.select("relation_id", "source_concept_id", "target_concept_id", F.upper(F.coalesce("relation", F.lit(""))).alias("relation"))
    r = _flag(_flag(ends, c, "source_concept_id", "_s"), c, "target_concept_id", "_t")
    return (
        _repeated(concepts, [F.col("concept_id")], "duplicate concept_id")
        .union(_told(c, [("non-global concept_id", ~F.col("concept_id").startswith(prefix))], F.col("concept_id")))
        .union(_repeated(chunks, [F.col("chunk_id")], "duplicate chunk_id"))
        .union(_told(m, [("dangling mention concept", ~F.col("_c")), ("dangling mention chunk", ~F.col("_k"))], F.col("mention_id")))
        .union(_told(r, [
            ("dangling relation endpoint", ~F.col("_s") | ~F.col("_t")),
            ("self relation", F.col("source_concept_id") == F.col("target_concept_id")),
            ("unsupported relation type", ~F.col("relation").isin(RELATIONS)),
        ], F.col("relation_id")))
        .union(_repeated(ends, [F.col("source_concept_id"), F.col("relation"), F.col("target_concept_id")], "duplicate relation"))
        .distinct()
    )


def layer_errors(layer: DataFrame, concepts: DataFrame, chunks: DataFrame, floor: float = PREREQUISITE_FLOOR, in_text: bool = True) -> DataFrame:
    """K7, and K1 for this layer: distinct ``rule``, ``key`` of what a prerequisite layer must not hold.

    layer: ``source``, ``target``, ``relation``, ``confidence``, ``chunk_id``, ``quote`` (of the pair), ``evidence`` (array of concept_id,
    chunk_id, quote). in_text: quotes must stand in their chunk (K7); otherwise they must only be given (K1).
    """
    key = F.concat_ws(" > ", "source", "target")
    rows = layer.withColumn("_id", F.xxhash64(*layer.columns))
    rows = _flag(_flag(rows, concepts.select("concept_id"), "source", "_s"), concepts.select("concept_id"), "target", "_t")
    given = lambda q: F.coalesce(q, F.lit("")) != ""
    quotes = rows.select("_id", F.lit("pair").alias("_part"), F.lit(None).cast("string").alias("concept_id"), "chunk_id", "quote").union(
        rows.select("_id", F.lit("evidence"), F.explode("evidence").alias("e")).select("_id", "evidence", "e.concept_id", "e.chunk_id", "e.quote")
    )
    if in_text:
        held = quotes.join(chunks.select("chunk_id", T.normalize_text("text").alias("_text")), "chunk_id", "left")
        judged = held.select("_id", "_part", "concept_id", F.coalesce(T.quote_in_normal(T.normalize_text("quote"), F.col("_text")), F.lit(False)).alias("_fine"))
    else:
        judged = _flag(quotes, chunks.select("chunk_id"), "chunk_id", "_there").select("_id", "_part", "concept_id", (F.col("_there") & given(F.col("quote"))).alias("_fine"))
    pair, evidence = F.col("_part") == "pair", F.col("_part") == "evidence"
    state = judged.groupBy("_id").agg(
        F.bool_and(F.when(pair, F.col("_fine"))).alias("_pair"), F.bool_or(evidence & ~F.col("_fine")).alias("_bad"), F.collect_set(F.when(evidence, F.col("concept_id"))).alias("_shown")
    )
    rows = rows.join(state, "_id", "left")
    rules = [
        ("dangling prerequisite endpoint", ~F.col("_s") | ~F.col("_t")),
        ("self prerequisite", (F.coalesce("source", F.lit("")) == "") | (F.col("source") == F.col("target"))),
        ("invalid prerequisite relation type", F.coalesce("relation", F.lit("")) != "PREREQUISITE_OF"),
        ("prerequisite confidence below threshold", T.clamp(F.col("confidence")) < floor),
        ("invalid prerequisite relationship evidence", ~F.col("_pair")),
        ("invalid prerequisite evidence", F.col("_bad")),
        ("prerequisite lacks evidence for both endpoints", ~(F.array_contains("_shown", F.col("source")) & F.array_contains("_shown", F.col("target")))),
    ]
    loops = G.cyclic_core(layer.where("source <> target")).select(F.lit("cyclic prerequisite layer").alias("rule"), key.alias("key"))
    return _told(rows, rules, key).union(_repeated(layer, [F.col("source"), F.col("target")], "duplicate prerequisite")).union(loops).distinct()


def relation_gate(quotes: DataFrame, concepts: DataFrame, chunks: DataFrame, supported: DataFrame, floor: float = RELATION_FLOOR) -> DataFrame:
    """K3: adds ``reason`` (null: accepted), ``source``, ``target`` (after repair of the direction) and ``kept`` to stated relations.

    quotes: ``source_concept_id``, ``target_concept_id``, ``relation``, ``chunk_id``, ``quote``, ``confidence``, ``place`` (order); concepts:
    ``concept_id``, ``names``, ``broader_concept_id``; supported: ``chunk_id``, ``concept_id`` with accepted evidence. Of accepted rows with the
    same ends, type and normalised quote the first in ``place`` is kept.
    """
    own = quotes.columns
    text = chunks.select("chunk_id", T.normalize_text("text").alias("_text"))
    rows = quotes.join(text, "chunk_id", "left").withColumn("_found", F.coalesce(T.quote_in_normal(T.normalize_text("quote"), F.col("_text")), F.lit(False))).drop("_text")
    some = supported.select("chunk_id", "concept_id").distinct()
    for end in ("source", "target"):
        side = concepts.select(F.col("concept_id").alias(f"{end}_concept_id"), F.col("names").alias(f"_{end}_names"), F.col("broader_concept_id").alias(f"_{end}_broader"), F.lit(True).alias(f"_{end}_known"))
        rows = rows.join(side, f"{end}_concept_id", "left")
        rows = rows.join(some.select("chunk_id", F.col("concept_id").alias(f"{end}_concept_id"), F.lit(True).alias(f"_{end}_shown")), ["chunk_id", f"{end}_concept_id"], "left")
    true = lambda c: F.coalesce(F.col(c), F.lit(False))
    named = F.coalesce(T.lexically_present(F.col("_source_names"), "quote"), F.lit(False)) | F.coalesce(T.lexically_present(F.col("_target_names"), "quote"), F.lit(False))
    reason = first_reason(
        (~(true("_source_known") & true("_target_known")), "unknown_or_non_candidate_endpoint"),
        (F.col("source_concept_id") == F.col("target_concept_id"), "self_loop"),
        (~F.coalesce(F.col("relation").isin(RELATIONS), F.lit(False)), "invalid_relation_type"),
        (T.clamp(F.col("confidence")) < floor, "below_confidence_threshold"),
        (~F.col("_found"), "quote_not_found_in_chunk"),
        (~(true("_source_shown") & true("_target_shown")), "relation_endpoint_without_same_chunk_evidence"),
        (~named, "relation_quote_lacks_named_endpoint_anchor"),
    )
    flip = ((F.col("relation") == "HAS_SUBTYPE") & F.coalesce(F.col("_source_broader") == F.col("target_concept_id"), F.lit(False))) | (F.col("relation").isin(SYMMETRIC) & (F.col("source_concept_id") > F.col("target_concept_id")))
    s, t = F.col("source_concept_id"), F.col("target_concept_id")
    rows = rows.select(*own, reason.alias("reason"), F.when(flip, t).otherwise(s).alias("source"), F.when(flip, s).otherwise(t).alias("target"), T.normalize_text("quote").alias("_q"))
    first = F.row_number().over(Window.partitionBy("source", "target", "relation", "_q", F.col("reason").isNull()).orderBy("place"))
    return rows.withColumn("kept", F.col("reason").isNull() & (first == 1)).drop("_q")


def relation_review(relations: DataFrame, concepts: DataFrame) -> DataFrame:
    """K5: adds ``final_relation``, ``reason`` (null: formal) and ``listed`` (the first of equal reviews) to relations.

    relations: ``relation_id``, ``source``, ``target``, ``relation``, ``status``, ``quotes`` (text); concepts: ``concept_id``, ``names``,
    ``broader_concept_id``, ``is_state``. The order of rules is fixed: status, type, rewriting of causes, hierarchy, the type's own
    cue, states, contrast within a hierarchy, general behind specific, both directions.
    """
    own = relations.columns
    q = F.coalesce("quotes", F.lit(""))
    cue = lambda kind: T.cue(q, kind)
    rows = relations
    for end in ("source", "target"):
        rows = rows.join(concepts.select(F.col("concept_id").alias(end), F.col("names").alias(f"_{end}_names"), F.col("broader_concept_id").alias(f"_{end}_broader"), F.col("is_state").alias(f"_{end}_state")), end, "left")
    kind = F.col("relation")
    rows = rows.withColumn("final_relation", F.when((kind == "CAUSES") & cue("reduction"), "REDUCES").when((kind == "CAUSES") & cue("increase"), "INCREASES").otherwise(kind))
    f = F.col("final_relation")
    lacks = [
        ("CAUSES", "causal", "cause_quote_lacks_explicit_causal_language"),
        ("REDUCES", "reduction", "reduces_quote_lacks_explicit_decrease_language"),
        ("INCREASES", "increase", "increases_quote_lacks_explicit_increase_language"),
        ("MANAGES", "management", "manages_used_without_explicit_management_evidence"),
        ("PROVIDES", "provision", "provides_used_without_explicit_provision_evidence"),
        ("ENABLES", "enablement", "enables_used_without_explicit_enablement_evidence"),
    ]
    named = lambda end: F.coalesce(T.lexically_present(F.col(f"_{end}_names"), "quotes"), F.lit(False))
    state = lambda end: F.coalesce(F.col(f"_{end}_state"), F.lit(False))
    within = F.coalesce(F.col("_target_broader") == F.col("source"), F.lit(False)) | F.coalesce(F.col("_source_broader") == F.col("target"), F.lit(False))
    rows = rows.withColumn("reason", first_reason(
        (~F.coalesce(F.upper("status").isin("VERIFIED", "VERIFIED_REVERSED", "VERIFIED_RETYPED"), F.lit(False)), "relation_not_semantically_verified"),
        (~F.coalesce(kind.isin(RELATIONS), F.lit(False)), "relation_type_requires_reviewed_layer"),
        ((f == "HAS_SUBTYPE") & ~F.col("_target_broader").eqNullSafe(F.col("source")), "subtype_not_confirmed_by_global_hierarchy"),
        *(((f == k) & ~cue(c), reason) for k, c, reason in lacks),
        ((f == "TRANSITIONS_TO") & ~(state("source") & state("target") & cue("transition") & named("source") & named("target")), "state_transition_requires_two_explicit_state_nodes_and_transition_evidence"),
        ((f == "CONTRASTED_WITH") & within, "contrast_between_category_and_its_subtype"),
    ))
    rows = rows.select(*own, "final_relation", "reason")
    # Both later rules ask about other formal relations of the same pair; one window answers both.
    pair = Window.partitionBy(F.least("source", "target"), F.greatest("source", "target"))
    formal = F.col("reason").isNull()
    specific = F.collect_set(F.when(formal & f.isin("INVOKES", "SCHEDULES", "CREATES", "LOADS_FROM"), F.col("source"))).over(pair)
    rows = rows.withColumn("_specific", specific)
    rows = rows.withColumn("reason", F.when(formal & (f == "USES") & F.array_contains("_specific", F.col("source")), "generic_uses_shadowed_by_specific_relation").otherwise(F.col("reason")))
    both = F.size(F.collect_set(F.when(formal & f.isin(DIRECTIONAL), F.col("source"))).over(Window.partitionBy(F.least("source", "target"), F.greatest("source", "target"), "final_relation"))) > 1
    rows = rows.withColumn("_both", both).withColumn("reason", F.when(formal & F.col("_both") & f.isin(DIRECTIONAL), "reciprocal_directional_relation").otherwise(F.col("reason")))
    first = F.row_number().over(Window.partitionBy("source", "target", "final_relation", "reason").orderBy("relation_id"))
    return rows.withColumn("listed", F.col("reason").isNotNull() & (first == 1)).select(*own, "final_relation", "reason", "listed")


def prerequisite_gate(candidates: DataFrame, decisions: DataFrame, concepts: DataFrame, chunks: DataFrame, floor: float = PREREQUISITE_FLOOR) -> DataFrame:
    """K6: ``pair_id``, ``source``, ``target``, ``confidence``, ``reason`` (null: proposed) of candidate pairs after decisions on them.

    candidates: ``pair_id``, ``a``, ``b``, ``origins`` (array); decisions: ``pair_id``, ``decision``, ``prerequisite``, ``dependent``, ``confidence``,
    ``chunk_id``, ``quote``, ``evidence`` (array of concept_id, chunk_id, quote), one row a pair; concepts: ``concept_id``, ``names``,
    ``short_definition``. A candidate without a decision is not direct. Ends are given once the decision's ends are the pair's.
    """
    d = candidates.join(decisions, "pair_id", "left")
    text = chunks.select("chunk_id", T.normalize_text("text").alias("_text"))
    quotes = d.select("pair_id", F.lit("").alias("concept_id"), "chunk_id", "quote").union(
        d.select("pair_id", "a", "b", F.explode("evidence").alias("e")).where("e.concept_id IN (a, b)").select("pair_id", "e.concept_id", "e.chunk_id", "e.quote")
    )
    held = quotes.join(text, "chunk_id", "left").where(F.coalesce(T.quote_in_normal(T.normalize_text("quote"), F.col("_text")), F.lit(False))).select("pair_id", "concept_id", "quote")
    terms = concepts.select("concept_id", T.anchor_terms(F.col("names"), "short_definition").alias("_terms"))
    anchored = T.anchored(held.where("concept_id <> ''").withColumn("_kind", F.lit("mention")).join(terms, "concept_id"), "_terms", "quote", "_kind").where("anchor IS NOT NULL")
    shown = anchored.groupBy("pair_id").agg(F.collect_set("concept_id").alias("_shown"))
    both = held.where("concept_id = ''").join(d.select("pair_id", "prerequisite", "dependent"), "pair_id")
    for end in ("prerequisite", "dependent"):
        both = both.join(concepts.select(F.col("concept_id").alias(end), F.col("names").alias(f"_{end}")), end)
    named = both.where(T.lexically_present(F.col("_prerequisite"), "quote") & T.lexically_present(F.col("_dependent"), "quote")).select("pair_id", F.lit(True).alias("_named")).distinct()
    rows = d.join(shown, "pair_id", "left").join(named, "pair_id", "left")
    formal = F.filter("origins", lambda o: o.startswith("formal:"))
    causal = F.array(*map(F.lit, ONLY_CAUSAL))
    p, t = F.coalesce("prerequisite", F.lit("")), F.coalesce("dependent", F.lit(""))
    fits = (p != t) & (((p == F.col("a")) & (t == F.col("b"))) | ((p == F.col("b")) & (t == F.col("a"))))
    sure = T.clamp(F.col("confidence"))
    reason = first_reason(
        (F.upper(F.coalesce("decision", F.lit(""))) == "VERIFIER_FAILURE", "pedagogical_verifier_failure"),
        (F.upper(F.coalesce("decision", F.lit(""))) != "DIRECT_PREREQUISITE", "not_a_direct_pedagogical_prerequisite"),
        (F.arrays_overlap("origins", F.array(*map(F.lit, NO_PREREQUISITE))), "taxonomy_example_or_contrast_is_not_a_direct_prerequisite"),
        ((F.size(formal) > 0) & (F.size(F.array_except(formal, causal)) == 0), "causal_or_quantitative_association_is_not_a_direct_prerequisite"),
        (~fits, "verifier_returned_invalid_endpoint_or_direction"),
        (sure < floor, "pedagogical_confidence_below_threshold"),
        (~F.coalesce("_named", F.lit(False)), "missing_validated_relationship_evidence_naming_both_endpoints"),
        (~F.coalesce(F.array_contains("_shown", p) & F.array_contains("_shown", t), F.lit(False)), "missing_validated_evidence_for_both_prerequisite_endpoints"),
    )
    told = F.coalesce(~reason.isin("pedagogical_verifier_failure", "not_a_direct_pedagogical_prerequisite", "taxonomy_example_or_contrast_is_not_a_direct_prerequisite", "causal_or_quantitative_association_is_not_a_direct_prerequisite", "verifier_returned_invalid_endpoint_or_direction"), F.lit(True))
    return rows.select("pair_id", F.when(told, p).alias("source"), F.when(told, t).alias("target"), F.when(told, F.round(sure, 4)).alias("confidence"), reason.alias("reason"))


def final_report(concepts: DataFrame, chunks: DataFrame, mentions: DataFrame, relations: DataFrame, max_chars: int = 2400, samples: int = SAMPLES) -> DataFrame:
    """K8: ``check``, ``n``, ``fatal`` (whether it fails the graph if n > 0), ``samples`` (the first ``samples`` keys in order); one row a check.

    concepts: ``concept_id``; chunks: ``chunk_id``, ``text``, ``excluded_tail_chars``; mentions: both keys; relations: ``source``, ``target``, ``relation``.
    """
    c, k = concepts.select("concept_id"), chunks.select("chunk_id")
    m = _flag(_flag(mentions.select("concept_id", "chunk_id"), c, "concept_id", "_c"), k, "chunk_id", "_k")
    edge = F.concat_ws(" > ", "source", "relation", "target")
    r = _flag(_flag(relations.select("source", "target", "relation"), c, "source", "_s"), c, "target", "_t")
    counted = relations.groupBy("source", "target", "relation").agg(F.count(F.lit(1)).alias("_n"))
    directed = counted.where(F.col("relation").isin(DIRECTIONAL) & (F.col("source") != F.col("target")))
    opposite = G.reciprocal(directed.select("source", "target", "relation"))
    text = F.coalesce("text", F.lit(""))
    rows = (
        _told(m, [("dangling_mentions", ~F.col("_c") | ~F.col("_k"))], F.concat_ws(" > ", "concept_id", "chunk_id"))
        .union(_told(r, [("invalid_relation_endpoints", ~F.col("_s") | ~F.col("_t")), ("self_loops", F.col("source") == F.col("target")), ("invalid_relation_types", ~F.coalesce(F.col("relation").isin(RELATIONS), F.lit(False)))], edge))
        .union(_told(opposite, [("reciprocal_directional_relations", F.lit(True))], edge))
        .union(_told(chunks, [
            ("oversized_chunks", F.length(text) > max_chars),
            ("suspected_incomplete_sentence_chunks", (F.coalesce("excluded_tail_chars", F.lit(0)) > 0) & T.incomplete_end(text)),
            ("suspicious_fragment_start_chunks", T.damaged_start(text)),
        ], F.col("chunk_id")))
    )
    extra = concepts.groupBy("concept_id").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0").select(F.lit("duplicate_concept_ids").alias("rule"), F.col("concept_id").alias("key"), "n").union(
        counted.where("_n > 1").select(F.lit("duplicate_relation_keys"), edge, F.col("_n") - 1)
    )
    each = rows.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).union(extra)
    ranked = each.withColumn("_place", F.row_number().over(Window.partitionBy("rule").orderBy("key")))
    shown = ranked.where(F.col("_place") <= samples).groupBy("rule").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "key"))), lambda x: x["key"]).alias("samples"))
    fatal = ["duplicate_concept_ids", "dangling_mentions", "invalid_relation_endpoints", "self_loops", "invalid_relation_types", "duplicate_relation_keys", "reciprocal_directional_relations", "oversized_chunks", "suspected_incomplete_sentence_chunks"]
    names = concepts.sparkSession.createDataFrame([(x, True) for x in fatal] + [("suspicious_fragment_start_chunks", False)], "rule string, fatal boolean")
    found = each.groupBy("rule").agg(F.sum("n").alias("n"))
    return names.join(found, "rule", "left").join(shown, "rule", "left").select(F.col("rule").alias("check"), F.coalesce("n", F.lit(0).cast("long")).alias("n"), "fatal", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def final_status(report: DataFrame, layer: DataFrame, new_candidates: int = 0, unresolved: int = 0, extraction_errors: int = 0) -> DataFrame:
    """K9: ``status``, ``errors`` - PASSED, WARN (only errors of single chunks) or FAILED, from a final report and a layer's errors."""
    fatal = report.agg(F.coalesce(F.bool_or(F.col("fatal") & (F.col("n") > 0)), F.lit(False)).alias("fatal"))
    errors = layer.agg(F.array_sort(F.collect_set("rule")).alias("errors"))
    open_names = new_candidates > 0 or unresolved > 0
    both = fatal.crossJoin(errors)  # one row each
    all_errors = F.concat("errors", F.array(F.lit("unresolved global-concept alignment")) if open_names else F.array().cast("array<string>"))
    failed = F.col("fatal") | (F.size("errors") > 0) | F.lit(open_names)
    return both.select(F.when(failed, "FAILED").when(F.lit(extraction_errors > 0), "WARN").otherwise("PASSED").alias("status"), all_errors.alias("errors"))


# Shapes of names that are no concepts, by what they are.
VARIABLES = [r"^[a-z][A-Za-z]*[0-9]$", r"^[A-Z][a-z]+[Vv]ariable$", r"^[A-Z][a-z]+Array$", r"^Flag_?[a-zA-Z0-9]+$", r"^Struct(ure)?Of.+"]
FIGURES = [r"^Figure\d", r"^Fig[_\.]?\d", r"^Table\d", r"^Chart\d", r".*(Diagram|Illustration|Schematic)$"]
ROLES = [r"^(Producer|Consumer)(Process|Thread|Application)$", r"^(Reader|Writer)(Process|Thread)$", r"^(Client|Server)Process$", r"^Example[A-Z]"]
DETAILS = [r".{40,}", r".*(Data|Info)Structure$", r".*Manipulation(Function)?$", r".*ForCriticalSection$", r".*InPetersonSolution$"]
# Words by which a text defines what it names.
DEFINES = ["is defined as", "refers to", "means", "denotes", "is a ", "is an ", "are defined", "is called"]


def admit_names(names: DataFrame, accept: int = 5, demote: int = 3) -> DataFrame:
    """Adds ``points`` (of seven) and ``verdict`` to names with counts of their use.

    Needs ``name``, ``definitions``, ``titles``, ``occurrences``, ``chunks``, ``relations``; null counts are none. The rules: defined; in a
    title or five times in the text; neither variable nor role; two relations; no variable, role or detail of a program; no figure or
    table; in three chunks. A name of a variable, role, detail, figure or table is rejected whatever its points.
    """
    like = lambda *shapes: F.coalesce(F.col("name").rlike("|".join(f"(?:{s})" for many in shapes for s in many)), F.lit(False))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    plain, figure = ~like(VARIABLES, ROLES, DETAILS), like(FIGURES)
    rules = [n("definitions") > 0, (n("titles") > 0) | (n("occurrences") >= 5), ~like(VARIABLES, ROLES), n("relations") >= 2, plain, ~figure, n("chunks") >= 3]
    points = sum((r.cast("int") for r in rules), F.lit(0))
    verdict = F.when(~plain | figure, "reject").when(points >= accept, "accept").when(points >= demote, "demote_to_mention").otherwise("reject")
    return names.withColumn("points", points).withColumn("verdict", verdict)


def classified(names: DataFrame, decisions: DataFrame) -> DataFrame:
    """``name``, ``class`` - Core, Supporting or Mention of names by decisions on them, else rejected; a name without a decision is rejected.

    decisions: ``name``, ``valid``, ``importance``; of several the first in order counts.
    """
    one = decisions.groupBy("name").agg(F.min(F.struct((~F.coalesce("valid", F.lit(False))).alias("no"), F.initcap(F.trim(F.coalesce("importance", F.lit("")))).alias("kind"))).alias("d"))
    kind = F.when(F.col("d.no") | F.col("d").isNull(), "rejected").when(F.col("d.kind").isin("Core", "Supporting", "Mention"), F.col("d.kind")).otherwise("rejected")
    return names.join(one, "name", "left").select("name", kind.alias("class"))


def recover_evidence(missing: DataFrame, chunks: DataFrame, hits: DataFrame) -> DataFrame:
    """``concept_id``, ``chunk_id``, ``quote``, ``confidence`` - for concepts without evidence the first sentence that names them.

    missing: ``concept_id``, ``names``, ``short_definition``; chunks: ``chunk_id``, ``text``; hits: ``concept_id``, ``chunk_id`` of chunks that name a
    concept. The first chunk in order with a sentence that names the concept and is anchored to it counts. A sentence
    ends at a mark and white space, or at an empty line.
    """
    terms = missing.select("concept_id", "names", T.anchor_terms(F.col("names"), "short_definition").alias("_terms"))
    pairs = hits.select("concept_id", "chunk_id").distinct().join(terms.select("concept_id"), "concept_id", "left_semi")
    wanted = chunks.join(pairs.select("chunk_id").distinct(), "chunk_id", "left_semi")
    parts = F.split("text", "(?<=[.!?])\\s+|\\n\\s*\\n")
    sentences = wanted.select("chunk_id", F.posexplode(parts).alias("_place", "quote")).withColumn("quote", F.trim("quote")).where("quote <> ''")
    named = pairs.join(sentences, "chunk_id").join(terms, "concept_id").where(T.lexically_present(F.col("names"), "quote"))
    fit = T.anchored(named.withColumn("_kind", F.lit("mention")), "_terms", "quote", "_kind").where("anchor IS NOT NULL")
    best = fit.groupBy("concept_id").agg(F.min(F.struct("chunk_id", "_place", "quote")).alias("b"))
    return best.select("concept_id", "b.chunk_id", F.substring("b.quote", 1, 700).alias("quote"), F.lit(RECOVERED_CONFIDENCE).alias("confidence"))


def coverage_gap(mapped: DataFrame, evidenced: DataFrame, target: float = 0.9) -> DataFrame:
    """``mapped``, ``evidenced``, ``wanted`` (rounded up), ``missing`` (to reach it) of concepts."""
    both = mapped.select("concept_id").distinct().join(evidenced.select("concept_id").distinct().withColumn("_e", F.lit(1)), "concept_id", "left")
    n = both.agg(F.count(F.lit(1)).alias("mapped"), F.count("_e").alias("evidenced"))
    wanted = F.ceil(F.round(F.col("mapped") * target, 9))
    return n.select("mapped", "evidenced", wanted.alias("wanted"), F.greatest(F.lit(0).cast("long"), wanted - F.col("evidenced")).alias("missing"))


# Order of what an audit looks at first, and what it may decide.
PRIORITY = ["subtype_cycle", "multiple_relations", "review_only", "alias_conflict", "derived_concept"]
ACTIONS = ["KEEP", "REMOVE", "RETYPE", "REVERSE", "MERGE", "REVIEW"]


def audit_candidates(review: DataFrame, relations: DataFrame, looped: DataFrame, conflicts: DataFrame, derived: DataFrame) -> DataFrame:
    """``kind``, ``item`` (the pair, alias or name), ``flags``, ``rank`` of everything an audit should see; lower ranks come first, then items.

    review, looped: ``source``, ``target``; relations: ``source``, ``target``, ``relation``; conflicts: ``alias``; derived: ``name``. A pair with
    several types of relation counts as such.
    """
    several = relations.groupBy("source", "target").agg(F.countDistinct("relation").alias("n")).where("n > 1")
    pair = F.concat_ws(" > ", "source", "target")
    flagged = lambda df, flag: df.where("source IS NOT NULL AND target IS NOT NULL").select(F.lit("relation").alias("kind"), pair.alias("item"), F.lit(flag).alias("flag"))
    all_ = (
        flagged(review, "review_only").union(flagged(several, "multiple_relations")).union(flagged(looped, "subtype_cycle"))
        .union(conflicts.select(F.lit("alias_conflict"), "alias", F.lit("alias_conflict"))).union(derived.select(F.lit("derived_concept"), "name", F.lit("derived_concept")))
    )
    rank = F.array_position(F.array(*map(F.lit, PRIORITY)), F.col("flag")) - 1
    out = all_.groupBy("kind", "item").agg(F.array_sort(F.collect_set("flag")).alias("flags"), F.min(rank).cast("int").alias("rank"))
    return out.select("kind", "item", F.array_join("flags", "|").alias("flags"), "rank")


def audit_decisions(candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """``item``, ``action``, ``new_relation``, ``confidence``, ``verified`` of every candidate after the answers on it.

    candidates: ``item``, ``evidence`` (text); answers: ``item``, ``action``, ``new_relations`` (array), ``confidence``, ``quote``. An unknown action,
    several new relations, an unknown relation and a missing answer become REVIEW; answers on nothing known and those with a
    confidence outside 0 and 1 are left out. A quote is verified if it stands in the evidence but for case and white space.
    """
    fine = answers.where(F.coalesce("confidence", F.lit(0.0)).between(0.0, 1.0))
    one = fine.groupBy("item").agg(F.min(F.struct("action", "new_relations", "confidence", "quote")).alias("d"))
    rows = candidates.join(one, "item", "left")
    many = F.coalesce(F.size("d.new_relations"), F.lit(0)) > 1
    kind = F.when(~many, F.get("d.new_relations", F.lit(0)))
    bad_kind = kind.isNotNull() & ~F.coalesce(kind.isin(RELATIONS), F.lit(False))
    action = F.upper(F.coalesce("d.action", F.lit("REVIEW")))
    action = F.when(many | bad_kind | ~action.isin(ACTIONS), "REVIEW").otherwise(action)
    flat = lambda c: F.lower(T.squeeze(F.coalesce(c, F.lit(""))))
    said = flat(F.col("d.quote"))
    return rows.select("item", action.alias("action"), F.when(~bad_kind, kind).alias("new_relation"), F.coalesce("d.confidence", F.lit(0.0)).alias("confidence"), ((said != "") & F.contains(flat(F.col("evidence")), said)).alias("verified"))


# Relations with one direction, and words of general names.
ASYMMETRIC = ["HAS_SUBTYPE", "PART_OF", "IMPLEMENTS", "USED_FOR", "REQUIRES", "CAUSES", "EXAMPLE_OF"]
GENERIC_TOKENS = "loader interface interpreter manager system service model structure kernel process primitive tool algorithm method approach mechanism protocol layer module component device resource".split()


def direction_scores(edges: DataFrame, concepts: DataFrame, mentions: DataFrame) -> DataFrame:
    """``source``, ``target``, ``relation``, ``score``, ``kept`` of relations of one direction that are stated in both.

    edges: ``source``, ``target``, ``relation``, ``quotes`` (array); concepts: ``concept_id``, ``name``, ``definition``, ``kind``, ``section``; mentions:
    ``concept_id``, ``chunk_id``. Quotes of both directions speak; for hierarchies so do the generality of kinds, names within names
    and definitions, how often each is mentioned, sections, and general words. Equal scores keep the lesser source.
    """
    one = edges.where(F.col("relation").isin(ASYMMETRIC) & (F.col("source") != F.col("target"))).groupBy("source", "target", "relation").agg(F.flatten(F.collect_list("quotes")).alias("quotes"))
    back = one.select(F.col("target").alias("source"), F.col("source").alias("target"), "relation", F.col("quotes").alias("back"))
    both = one.join(back, ["source", "target", "relation"])
    used = mentions.select("concept_id", "chunk_id").distinct().groupBy("concept_id").agg(F.count(F.lit(1)).alias("used"))
    facts = concepts.join(used, "concept_id", "left").select("concept_id", F.struct(
        F.lower(F.coalesce("name", F.lit(""))).alias("name"), F.lower(F.coalesce("definition", F.lit(""))).alias("text"), T.generality(F.col("kind")).alias("general"),
        F.coalesce("used", F.lit(0)).alias("used"), T.section_key(F.col("section"), 99).alias("section"),
    ).alias("f"))
    both = both.join(facts.select(F.col("concept_id").alias("source"), F.col("f").alias("s")), "source", "left").join(facts.select(F.col("concept_id").alias("target"), F.col("f").alias("t")), "target", "left")
    said = F.aggregate(F.transform(F.concat("quotes", "back"), lambda q: T.direction_signal(q, F.col("s.name"), F.col("t.name"), F.col("relation"))), F.lit(0.0), lambda x, y: x + F.coalesce(y, F.lit(0.0)))
    down = F.col("relation") == "HAS_SUBTYPE"
    both = both.withColumns({"b": F.when(down, F.col("s")).otherwise(F.col("t")), "n": F.when(down, F.col("t")).otherwise(F.col("s")), "said": said})
    name = lambda x: F.coalesce(F.col(f"{x}.name"), F.lit(""))
    text = lambda x: F.coalesce(F.col(f"{x}.text"), F.lit(""))
    word_in = lambda w, t: (w != "") & F.regexp_like(t, F.concat(F.lit("\\b\\Q"), w, F.lit("\\E\\b")))
    used_of = lambda x: F.coalesce(F.col(f"{x}.used"), F.lit(0))
    tokens = lambda x: F.array_distinct(F.regexp_extract_all(name(x), F.lit("[a-z]+"), 0))
    generic = lambda x: F.arrays_overlap(tokens(x), F.array(*map(F.lit, GENERIC_TOKENS)))
    differ = (name("b") != "") & (name("n") != "") & (name("b") != name("n"))
    sign = lambda plus, minus, size: F.when(F.coalesce(plus, F.lit(False)), size).when(F.coalesce(minus, F.lit(False)), -size).otherwise(0.0)
    hierarchy = (
        3.0 * (F.coalesce("b.general", F.lit(1)) - F.coalesce("n.general", F.lit(1)))
        + sign(differ & word_in(name("b"), name("n")), differ & word_in(name("n"), name("b")), 3.0)
        + F.when(word_in(name("b"), text("n")), 2.0).otherwise(0.0) - F.when(word_in(name("n"), text("b")), 1.0).otherwise(0.0)
        + sign((used_of("b") >= 1.5 * used_of("n")) & (used_of("b") > 0), (used_of("n") >= 1.5 * used_of("b")) & (used_of("n") > 0), 1.0)
        + F.when(down, sign(F.col("b.section") < F.col("n.section"), F.col("b.section") > F.col("n.section"), 0.5)).otherwise(0.0)
        + sign(generic("b") & ~generic("n"), generic("n") & ~generic("b"), 1.0)
        + sign(F.size(tokens("n")) > F.size(tokens("b")), F.size(tokens("b")) > F.size(tokens("n")), 0.5)
    )
    scored = both.select("source", "target", "relation", (2.0 * F.col("said") + F.when(F.col("relation").isin("HAS_SUBTYPE", "PART_OF", "EXAMPLE_OF"), hierarchy).otherwise(0.0)).alias("score"))
    return G.resolve_opposites(scored)
