"""Queries on gates, reports, recovery of evidence and audits, over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import candidates as C
from ..operators import gates as K
from ..operators import hierarchy as H
from ..operators import typing as R
from ..operators.validate import RELATIONS
from ..session import spread, stored, table
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()

_TYPES = ", ".join(f"'{r}'" for r in RELATIONS)
_DIRECTED = ", ".join(f"'{r}'" for r in K.DIRECTIONAL)
_ALL = "list_concat([canonical_name], coalesce(aliases, []))"


def _names():
    return F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))


def _flat(text: str) -> str:
    return f"(' ' || regexp_replace({text}, '[^a-z0-9]', ' ', 'g') || ' ')"


def _present(names: str, quote: str) -> str:
    """T13 in SQL: whether a text holds one of some names as a phrase."""
    return f"coalesce(len(list_filter(list_transform({names}, lambda x: {S.name('x')}), lambda z: z <> '' AND contains({_flat(S.search(quote))}, {_flat('z')}))) > 0, false)"


def _registry(spark: SparkSession, base: str) -> DataFrame:
    return V.concepts(spark, base, "canonical_name", "aliases", "short_definition", "broader_concept_id").select("concept_id", _names().alias("names"), "short_definition", "broader_concept_id", "canonical_name")


_QUOTES = """q AS (SELECT relation_id, generate_subscripts(evidence, 1) - 1 AS n, source_concept_id AS s, target_concept_id AS t, relation, confidence, unnest(evidence) AS e FROM g_relation),
c AS (SELECT concept_id, list_concat([canonical_name], coalesce(aliases, [])) AS names, broader_concept_id AS broader FROM g_concept),
m AS (SELECT DISTINCT chunk_id, concept_id FROM g_mention WHERE evidence_type IS NOT NULL)"""


@query(
    V.sql("g_concept", "g_chunk", "g_mention", "g_relation") + f""", {_QUOTES},
j AS (SELECT q.*, k.text, a.concept_id IS NOT NULL AND b.concept_id IS NOT NULL AS known, a.broader AS sb, ma.concept_id IS NOT NULL AND mb.concept_id IS NOT NULL AS shown, {_present('a.names', 'q.e.quote')} OR {_present('b.names', 'q.e.quote')} AS named, {S.normal_text('q.e.quote')} AS nq
 FROM q LEFT JOIN g_chunk k ON k.chunk_id = q.e.chunk_id LEFT JOIN c a ON a.concept_id = s LEFT JOIN c b ON b.concept_id = t LEFT JOIN m ma ON ma.concept_id = s AND ma.chunk_id = q.e.chunk_id LEFT JOIN m mb ON mb.concept_id = t AND mb.chunk_id = q.e.chunk_id),
r AS (SELECT *, CASE WHEN NOT known THEN 'unknown_or_non_candidate_endpoint' WHEN s = t THEN 'self_loop' WHEN coalesce(relation, '') NOT IN ({_TYPES}) THEN 'invalid_relation_type' WHEN confidence < 0.82 THEN 'below_confidence_threshold'
 WHEN NOT coalesce({S.quote_in('e.quote', 'text')}, false) THEN 'quote_not_found_in_chunk' WHEN NOT shown THEN 'relation_endpoint_without_same_chunk_evidence' WHEN NOT named THEN 'relation_quote_lacks_named_endpoint_anchor' END AS reason,
 coalesce((relation = 'HAS_SUBTYPE' AND coalesce(sb = t, false)) OR (relation = 'CONTRASTED_WITH' AND s > t), false) AS flip FROM j),
f AS (SELECT *, CASE WHEN flip THEN t ELSE s END AS source, CASE WHEN flip THEN s ELSE t END AS target FROM r)
SELECT relation_id, n, reason, source, target, reason IS NULL AND row_number() OVER (PARTITION BY source, target, relation, nq, reason IS NULL ORDER BY relation_id, n) = 1 AS kept FROM f"""
)
def relation_validation(spark: SparkSession, base: str) -> DataFrame:
    """K3: why each stated quote of a relation is refused, or null; its repaired ends; and whether it is the first of its kind."""
    q = V.relations(spark, base, "evidence").select("relation_id", "source_concept_id", "target_concept_id", "relation", "confidence", F.posexplode("evidence").alias("n", "e"))
    q = q.select("relation_id", "n", "source_concept_id", "target_concept_id", "relation", "confidence", "e.chunk_id", "e.quote", F.struct("relation_id", "n").alias("place"))
    shown = V.mentions(spark, base, "evidence_type").where("evidence_type IS NOT NULL")
    return K.relation_gate(q, _registry(spark, base), V.chunks(spark, base, "text"), shown).select("relation_id", "n", "reason", "source", "target", "kept")


_LACKS = [("CAUSES", "causal", "cause_quote_lacks_explicit_causal_language"), ("REDUCES", "reduction", "reduces_quote_lacks_explicit_decrease_language"), ("INCREASES", "increase", "increases_quote_lacks_explicit_increase_language"), ("MANAGES", "management", "manages_used_without_explicit_management_evidence"), ("PROVIDES", "provision", "provides_used_without_explicit_provision_evidence"), ("ENABLES", "enablement", "enables_used_without_explicit_enablement_evidence")]


@query(
    V.sql("g_concept", "g_relation") + f""", c AS (SELECT concept_id, {_ALL} AS names, broader_concept_id AS broader, coalesce(regexp_matches(canonical_name, '(?i)\\bstate\\b'), false) AS is_state FROM g_concept),
x AS (SELECT relation_id, source_concept_id AS s, target_concept_id AS t, relation, verification_status AS status, coalesce(array_to_string(list_transform(evidence, lambda e: e.quote), ' '), '') AS q FROM g_relation),
f AS (SELECT x.*, b.broader AS tb, a.broader AS sb, coalesce(a.is_state AND b.is_state, false) AS states, {_present('a.names', 'q')} AND {_present('b.names', 'q')} AS named, CASE WHEN relation = 'CAUSES' AND {S.cue('q', 'reduction')} THEN 'REDUCES' WHEN relation = 'CAUSES' AND {S.cue('q', 'increase')} THEN 'INCREASES' ELSE relation END AS fin FROM x LEFT JOIN c a ON a.concept_id = s LEFT JOIN c b ON b.concept_id = t),
r AS (SELECT *, CASE WHEN coalesce(upper(status), '') NOT IN ('VERIFIED', 'VERIFIED_REVERSED', 'VERIFIED_RETYPED') THEN 'relation_not_semantically_verified' WHEN coalesce(relation, '') NOT IN ({_TYPES}) THEN 'relation_type_requires_reviewed_layer' WHEN fin = 'HAS_SUBTYPE' AND tb IS DISTINCT FROM s THEN 'subtype_not_confirmed_by_global_hierarchy'
 {' '.join(f"WHEN fin = '{k}' AND NOT {S.cue('q', c)} THEN '{why}'" for k, c, why in _LACKS)} WHEN fin = 'TRANSITIONS_TO' AND NOT (states AND named AND {S.cue('q', 'transition')}) THEN 'state_transition_requires_two_explicit_state_nodes_and_transition_evidence'
 WHEN fin = 'CONTRASTED_WITH' AND (coalesce(tb = s, false) OR coalesce(sb = t, false)) THEN 'contrast_between_category_and_its_subtype' END AS reason FROM f),
g AS (SELECT * REPLACE (CASE WHEN reason IS NULL AND fin = 'USES' AND EXISTS (SELECT 1 FROM r o WHERE o.reason IS NULL AND o.s = r.s AND o.t = r.t AND o.fin IN ('INVOKES', 'SCHEDULES', 'CREATES', 'LOADS_FROM')) THEN 'generic_uses_shadowed_by_specific_relation' ELSE reason END AS reason) FROM r),
h AS (SELECT * REPLACE (CASE WHEN reason IS NULL AND fin IN ({_DIRECTED}) AND s <> t AND EXISTS (SELECT 1 FROM g o WHERE o.reason IS NULL AND o.s = g.t AND o.t = g.s AND o.fin = g.fin) THEN 'reciprocal_directional_relation' ELSE reason END AS reason) FROM g)
SELECT relation_id, fin AS final_relation, reason, reason IS NOT NULL AND row_number() OVER (PARTITION BY s, t, fin, reason ORDER BY relation_id) = 1 AS listed FROM h"""
)
def semantic_gate(spark: SparkSession, base: str) -> DataFrame:
    """K5: relations after the semantic gate, with the reason for review."""
    r = V.relations(spark, base, "evidence", "verification_status").select("relation_id", F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation", F.col("verification_status").alias("status"), F.coalesce(F.array_join("evidence.quote", " "), F.lit("")).alias("quotes"))
    c = _registry(spark, base).withColumn("is_state", F.coalesce(F.col("canonical_name").rlike("(?i)\\bstate\\b"), F.lit(False)))
    return K.relation_review(r, c).select("relation_id", "final_relation", "reason", "listed")


@query(
    V.sql("g_concept", "g_chunk", "g_relation") + f""", c AS (SELECT concept_id, {_ALL} AS names FROM g_concept),
d AS (SELECT relation_id, source_concept_id AS a, target_concept_id AS b, relation, verification_status AS status, confidence, evidence[1].chunk_id AS chunk_id, evidence[1].quote AS quote, evidence FROM g_relation),
p AS (SELECT d.*, CASE WHEN status = 'VERIFIED_REVERSED' THEN b ELSE a END AS pre, CASE WHEN status = 'VERIFIED_REVERSED' THEN a ELSE b END AS dep FROM d),
w AS (SELECT p.*, coalesce({S.quote_in('quote', 'k.text')}, false) AND {_present('x.names', 'quote')} AND {_present('y.names', 'quote')} AS named FROM p LEFT JOIN g_chunk k USING (chunk_id) LEFT JOIN c x ON x.concept_id = pre LEFT JOIN c y ON y.concept_id = dep),
i AS (SELECT relation_id, unnest(evidence) AS e, a, b FROM d), v AS (SELECT relation_id, concept_id FROM (SELECT relation_id, e, unnest([a, b]) AS concept_id FROM i) z JOIN g_chunk k ON k.chunk_id = e.chunk_id JOIN c USING (concept_id) WHERE coalesce({S.quote_in('e.quote', 'k.text')}, false)
 AND ({_present('c.names', 'e.quote')} OR coalesce(list_max(list_transform(list_transform(c.names, lambda x: list_filter({S.words(S.name('x', True))}, lambda y: length(y) > 2 AND y NOT IN ({", ".join(f"'{s}'" for s in T.ANCHOR_STOPS)}))), lambda ws: CASE WHEN len(ws) >= 2 AND len(list_intersect(ws, {S.words(S.name('e.quote', True))})) >= 2 THEN len(list_intersect(ws, {S.words(S.name('e.quote', True))}))::DOUBLE / len(ws) ELSE 0.0 END)), 0.0) >= 0.67)),
s AS (SELECT relation_id, list_distinct(list(concept_id)) AS shown FROM v GROUP BY 1),
r AS (SELECT w.*, CASE WHEN status IS NULL THEN 'pedagogical_verifier_failure' WHEN status NOT IN ('VERIFIED', 'VERIFIED_REVERSED') THEN 'not_a_direct_pedagogical_prerequisite' WHEN relation IN ('HAS_SUBTYPE', 'EXAMPLE_OF', 'CONTRASTED_WITH') THEN 'taxonomy_example_or_contrast_is_not_a_direct_prerequisite'
 WHEN relation IN ('CAUSES', 'INCREASES', 'REDUCES') THEN 'causal_or_quantitative_association_is_not_a_direct_prerequisite' WHEN pre = dep THEN 'verifier_returned_invalid_endpoint_or_direction' WHEN confidence < 0.85 THEN 'pedagogical_confidence_below_threshold'
 WHEN NOT named THEN 'missing_validated_relationship_evidence_naming_both_endpoints' WHEN NOT coalesce(list_contains(shown, pre) AND list_contains(shown, dep), false) THEN 'missing_validated_evidence_for_both_prerequisite_endpoints' END AS reason FROM w LEFT JOIN s USING (relation_id))
SELECT relation_id AS pair_id, CASE WHEN told THEN pre END AS source, CASE WHEN told THEN dep END AS target, CASE WHEN told THEN round(confidence, 4) END AS confidence, reason FROM (SELECT *, coalesce(reason IN ('pedagogical_confidence_below_threshold', 'missing_validated_relationship_evidence_naming_both_endpoints', 'missing_validated_evidence_for_both_prerequisite_endpoints'), true) AS told FROM r)"""
)
def prerequisite_gate(spark: SparkSession, base: str) -> DataFrame:
    """K6: related pairs as candidates for prerequisites, decided by how their relation was verified; its quotes are the evidence for both ends."""
    r = V.relations(spark, base, "evidence", "verification_status")
    a, b, status = F.col("source_concept_id"), F.col("target_concept_id"), F.col("verification_status")
    candidates = r.select(F.col("relation_id").alias("pair_id"), a.alias("a"), b.alias("b"), F.array(F.concat(F.lit("formal:"), F.coalesce("relation", F.lit("")))).alias("origins"))
    back = F.coalesce(status == "VERIFIED_REVERSED", F.lit(False))
    each = F.flatten(F.transform("evidence", lambda e: F.array(*(F.struct(c.alias("concept_id"), e["chunk_id"].alias("chunk_id"), e["quote"].alias("quote")) for c in (a, b)))))
    decisions = r.select(
        F.col("relation_id").alias("pair_id"), F.when(status.isNull(), "VERIFIER_FAILURE").when(status.isin("VERIFIED", "VERIFIED_REVERSED"), "DIRECT_PREREQUISITE").otherwise("OTHER").alias("decision"),
        F.when(back, b).otherwise(a).alias("prerequisite"), F.when(back, a).otherwise(b).alias("dependent"), "confidence", F.get("evidence.chunk_id", F.lit(0)).alias("chunk_id"), F.get("evidence.quote", F.lit(0)).alias("quote"), each.alias("evidence"),
    )
    return K.prerequisite_gate(candidates, decisions, _registry(spark, base), V.chunks(spark, base, "text"))


@query("WITH c AS (SELECT DISTINCT name FROM concepts WHERE name IS NOT NULL), p AS (SELECT prereq AS s, target AS t, confidence FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL)," + f""" e AS (SELECT DISTINCT s, t FROM p WHERE s <> t), x AS (SELECT *, s || ' > ' || t AS key FROM p)
SELECT DISTINCT rule, key FROM (SELECT 'dangling prerequisite endpoint' AS rule, key FROM x WHERE s NOT IN (SELECT name FROM c) OR t NOT IN (SELECT name FROM c) UNION ALL SELECT 'self prerequisite', key FROM x WHERE s = t OR s = ''
UNION ALL SELECT 'prerequisite confidence below threshold', key FROM x WHERE {S.clamp('confidence')} < 0.85 UNION ALL SELECT 'duplicate prerequisite', key FROM x GROUP BY s, t, key HAVING count(*) > 1
UNION ALL SELECT 'invalid prerequisite relationship evidence', key FROM x UNION ALL SELECT 'prerequisite lacks evidence for both endpoints', key FROM x)""")
def layer_validation(spark: SparkSession, base: str) -> DataFrame:
    """K7: what the prerequisite edges lack as a layer; they carry no quotes. Loops are in ``cycle_check``."""
    return K.layer_errors(_layer(spark, base), table(spark, base, "concepts").select(F.col("name").alias("concept_id")), V.chunks(spark, base, "text")).where("rule <> 'cyclic prerequisite layer'")


def _layer(spark: SparkSession, base: str) -> DataFrame:
    p = table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL")
    none = F.lit(None).cast("string")
    return p.select(F.col("prereq").alias("source"), "target", F.lit("PREREQUISITE_OF").alias("relation"), "confidence", none.alias("chunk_id"), none.alias("quote"), F.lit(None).cast("array<struct<concept_id:string,chunk_id:string,quote:string>>").alias("evidence"))


_CHECKS = f"""r AS (SELECT source_concept_id AS s, target_concept_id AS t, relation FROM g_relation), rk AS (SELECT s, t, relation, count(*) AS n FROM r GROUP BY ALL), b AS (SELECT chunk_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '^[{S.SPACES}]+', '') AS h, right({S.squeeze("coalesce(text, '')")}, 180) AS tail, coalesce(excluded_tail_chars, 0) AS cut FROM g_chunk),
k AS (SELECT 'dangling_mentions' AS "check", count(*) AS n, true AS fatal FROM g_mention WHERE concept_id NOT IN (SELECT concept_id FROM g_concept) OR chunk_id NOT IN (SELECT chunk_id FROM g_chunk)
UNION ALL SELECT 'invalid_relation_endpoints', count(*), true FROM r WHERE s NOT IN (SELECT concept_id FROM g_concept) OR t NOT IN (SELECT concept_id FROM g_concept) UNION ALL SELECT 'self_loops', count(*), true FROM r WHERE s = t
UNION ALL SELECT 'invalid_relation_types', count(*), true FROM r WHERE coalesce(relation, '') NOT IN ({_TYPES}) UNION ALL SELECT 'duplicate_relation_keys', coalesce(sum(n - 1), 0)::BIGINT, true FROM rk UNION ALL SELECT 'duplicate_concept_ids', 0, true
UNION ALL SELECT 'reciprocal_directional_relations', count(*), true FROM rk x WHERE relation IN ({_DIRECTED}) AND s <> t AND EXISTS (SELECT 1 FROM rk y WHERE y.s = x.t AND y.t = x.s AND y.relation = x.relation)
UNION ALL SELECT 'oversized_chunks', count(*), true FROM b WHERE length(text) > 2400 UNION ALL SELECT 'suspected_incomplete_sentence_chunks', count(*), true FROM b WHERE cut > 0 AND tail <> '' AND NOT regexp_matches(tail, '[.!?;:)}}\\]]["'']?$') AND regexp_matches(tail, '(?i)\\b(a|an|the|and|or|but|to|of|in|on|for|with|from|that|which|whose|when|where)$')
UNION ALL SELECT 'suspicious_fragment_start_chunks', count(*), false FROM b WHERE regexp_matches(h, '^([,.;:)]|(?i)(is|are|was|were|and|or|but|which|that)\\b)'))"""


def _report(spark: SparkSession, base: str) -> DataFrame:
    r = V.relations(spark, base).select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation")
    return K.final_report(V.concepts(spark, base, "status"), V.chunks(spark, base, "text", "excluded_tail_chars"), V.mentions(spark, base, "concept_id"), r)


@query(V.sql("g_concept", "g_chunk", "g_mention", "g_relation") + f""", {_CHECKS} SELECT * FROM k""")
def final_validation(spark: SparkSession, base: str) -> DataFrame:
    """K8: the checks of the finished graph."""
    return _report(spark, base).select("check", "n", "fatal")


@query(V.sql("g_concept", "g_chunk", "g_mention", "g_relation") + f""", {_CHECKS} SELECT CASE WHEN count_if(fatal AND n > 0) > 0 OR (SELECT count(*) FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM k""")
def graph_status(spark: SparkSession, base: str) -> DataFrame:
    """K9: the status of the finished graph and its prerequisite layer."""
    layer = K.layer_errors(_layer(spark, base), table(spark, base, "concepts").select(F.col("name").alias("concept_id")), V.chunks(spark, base, "text"))
    return K.final_status(_report(spark, base), layer).select("status")


def _shape(shapes: list[list[str]]) -> str:
    return " OR ".join(f"regexp_matches(name, '{s}')" for many in shapes for s in many)


@query(V.sql("g_concept", "g_mention", "g_relation") + f""", m AS (SELECT concept_id, count_if(coalesce(evidence_type = 'definition', false) OR {' OR '.join(f"contains(lower(coalesce(quote, '')), '{w}')" for w in K.DEFINES)}) AS d, count(*) AS o, count(DISTINCT chunk_id) AS k FROM g_mention GROUP BY 1), r AS (SELECT c AS concept_id, count(*) AS r FROM (SELECT source_concept_id AS c FROM g_relation UNION ALL SELECT target_concept_id FROM g_relation) GROUP BY 1),
h AS (SELECT lower(title) AS title, count(*) AS n FROM chapters GROUP BY 1), x AS (SELECT concept_id, coalesce(name, '') AS name, coalesce(d, 0) AS d, coalesce(o, 0) AS o, coalesce(k, 0) AS k, coalesce(r, 0) AS r, coalesce(h.n, 0) AS t FROM g_concept LEFT JOIN m USING (concept_id) LEFT JOIN r USING (concept_id) LEFT JOIN h ON h.title = lower(canonical_name)),
f AS (SELECT *, {_shape([K.VARIABLES, K.ROLES])} AS vr, {_shape([K.VARIABLES, K.ROLES, K.DETAILS])} AS vrd, {_shape([K.FIGURES])} AS g FROM x), p AS (SELECT concept_id, vrd, g, (d > 0)::INT + (t > 0 OR o >= 5)::INT + (NOT vr)::INT + (r >= 2)::INT + (NOT vrd)::INT + (NOT g)::INT + (k >= 3)::INT AS points FROM f)
SELECT concept_id, points, CASE WHEN vrd OR g THEN 'reject' WHEN points >= 5 THEN 'accept' WHEN points >= 3 THEN 'demote_to_mention' ELSE 'reject' END AS verdict FROM p""")
def admission_verdicts(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts on concepts by their names and their use."""
    low = F.lower(F.coalesce("quote", F.lit("")))
    said = F.coalesce(F.col("evidence_type") == "definition", F.lit(False)) | F.exists(F.array(*map(F.lit, K.DEFINES)), lambda w: F.contains(low, w))
    m = V.mentions(spark, base, "evidence_type", "quote").groupBy("concept_id").agg(F.count_if(said).alias("definitions"), F.count(F.lit(1)).alias("occurrences"), F.countDistinct("chunk_id").alias("chunks"))
    r = V.relations(spark, base).select(F.explode(F.array("source_concept_id", "target_concept_id")).alias("concept_id")).groupBy("concept_id").agg(F.count(F.lit(1)).alias("relations"))
    h = table(spark, base, "chapters").groupBy(F.lower("title").alias("_title")).agg(F.count(F.lit(1)).alias("titles"))
    n = V.concepts(spark, base, "name", "canonical_name").join(m, "concept_id", "left").join(r, "concept_id", "left").withColumn("_title", F.lower("canonical_name")).join(h, "_title", "left")
    return K.admit_names(n).select("concept_id", "points", "verdict")


_NAMED = f"""d AS (SELECT DISTINCT concept_id, phrase FROM (SELECT concept_id, {S.name('n')} AS phrase FROM (SELECT concept_id, unnest({_ALL}) AS n FROM g_concept)) WHERE length(phrase) >= 3)"""


@query(V.sql("g_concept", "g_chunk", "g_mention") + f""", {_NAMED}, miss AS (SELECT concept_id FROM g_concept WHERE concept_id NOT IN (SELECT concept_id FROM g_mention WHERE evidence_type = 'definition' AND confidence >= 0.97)),
t AS (SELECT chunk_id, unnest(string_split(regexp_replace(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), '\\n[ \\t\\n\\x0B\\f\\r]*\\n', chr(1), 'g'), chr(1))) AS q, generate_subscripts(string_split(regexp_replace(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), '\\n[ \\t\\n\\x0B\\f\\r]*\\n', chr(1), 'g'), chr(1)), 1) AS n FROM g_chunk),
u AS (SELECT chunk_id, n, trim(q) AS quote, {_flat(S.search('q'))} AS f FROM t WHERE trim(q) <> ''), e AS (SELECT concept_id, chunk_id, n, quote FROM u JOIN (SELECT * FROM d JOIN miss USING (concept_id)) ON contains(f, {_flat('phrase')}))
SELECT concept_id, chunk_id, left(quote, 700) AS quote, 0.8::DOUBLE AS confidence FROM e QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY chunk_id, n) = 1""")
def evidence_recovery(spark: SparkSession, base: str) -> DataFrame:
    """For each concept that no sure evidence defines the first sentence of the first chunk that names it."""
    have = V.mentions(spark, base, "evidence_type", "confidence").where("evidence_type = 'definition' AND confidence >= 0.97").select("concept_id").distinct()
    missing = _registry(spark, base).join(have, "concept_id", "left_anti")
    chunks = V.chunks(spark, base, "text")
    return K.recover_evidence(missing, chunks, C.named_concepts(chunks, "chunk_id", "text", missing.select("concept_id", "names")))


@query(V.sql("g_concept", "g_mention") + ", e AS (SELECT DISTINCT concept_id FROM g_mention WHERE evidence_type IS NOT NULL), n AS (SELECT count(*) AS mapped, count(e.concept_id) AS evidenced FROM g_concept LEFT JOIN e USING (concept_id)) SELECT mapped, evidenced, ceil(round(mapped * 0.9::DOUBLE, 9))::BIGINT AS wanted, greatest(0, ceil(round(mapped * 0.9::DOUBLE, 9))::BIGINT - evidenced) AS missing FROM n")
def coverage_target(spark: SparkSession, base: str) -> DataFrame:
    """How many concepts still need evidence to reach the target."""
    return K.coverage_gap(V.concepts(spark, base, "status"), V.mentions(spark, base, "evidence_type").where("evidence_type IS NOT NULL"))


_MARKED = " OR ".join(f"contains(canonical_name, '{m}')" for m in ("Replicated", "Redundant", "Optimized"))


@query(V.sql("g_concept", "g_relation", recursive=True) + f""", r AS (SELECT source_concept_id AS s, target_concept_id AS t, relation, verification_status AS v FROM g_relation), se AS (SELECT DISTINCT parent AS s, child AS t FROM subtype_edges WHERE parent IS NOT NULL AND child IS NOT NULL), reach(s, t) AS (SELECT s, t FROM se UNION SELECT a.s, b.t FROM reach a JOIN se b ON b.s = a.t),
al AS (SELECT lower(trim(a)) AS alias FROM (SELECT concept_id, unnest(aliases) AS a FROM g_concept) WHERE trim(a) <> '' GROUP BY 1 HAVING count(DISTINCT concept_id) > 1),
u AS (SELECT 'relation' AS kind, s || ' > ' || t AS item, 'review_only' AS flag FROM r WHERE v = 'PENDING' UNION SELECT 'relation', s || ' > ' || t, 'multiple_relations' FROM r GROUP BY s, t HAVING count(DISTINCT relation) > 1 UNION SELECT 'relation', s || ' > ' || t, 'subtype_cycle' FROM se WHERE s = t OR EXISTS (SELECT 1 FROM reach x WHERE x.s = se.t AND x.t = se.s)
 UNION SELECT 'alias_conflict', alias, 'alias_conflict' FROM al UNION SELECT 'derived_concept', canonical_name, 'derived_concept' FROM g_concept WHERE {_MARKED})
SELECT kind, item, array_to_string(list_sort(list_distinct(list(flag))), '|') AS flags, min(CASE flag WHEN 'subtype_cycle' THEN 0 WHEN 'multiple_relations' THEN 1 WHEN 'review_only' THEN 2 WHEN 'alias_conflict' THEN 3 ELSE 4 END) AS "rank" FROM u GROUP BY kind, item""")
def audit_candidates(spark: SparkSession, base: str) -> DataFrame:
    """What an audit should see: unverified and multiple relations, subtype loops, shared aliases, derived names."""
    r = V.relations(spark, base, "verification_status").select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation", "verification_status")
    edges = H.layer_edges(table(spark, base, "subtype_edges"), "subtype", "parent", "child")
    loops = H.hierarchy(edges, "loops")
    part = lambda end: loops.select("layer", F.col("node").alias(end), F.col("loop").alias(f"_{end}"))
    looped = edges.join(part("parent"), ["layer", "parent"]).join(part("child"), ["layer", "child"]).where("_parent = _child").select(F.col("parent").alias("source"), F.col("child").alias("target"))
    c = V.concepts(spark, base, "canonical_name", "aliases")
    alias = c.select("concept_id", F.explode("aliases").alias("alias")).withColumn("alias", F.lower(F.trim("alias"))).where("alias <> ''").groupBy("alias").agg(F.countDistinct("concept_id").alias("n")).where("n > 1")
    derived = c.where(F.expr(_MARKED)).select(F.col("canonical_name").alias("name")).distinct()
    return K.audit_candidates(r.where("verification_status = 'PENDING'"), r, looped, alias, derived)


@query(f"""WITH x AS (SELECT a || ' > ' || b AS item, CASE lower(trim(relation)) WHEN 'same' THEN 'merge' WHEN 'different' THEN 'KEEP' WHEN 'subset' THEN 'RETYPE' ELSE relation END AS action, CASE WHEN lower(trim(relation)) = 'subset' THEN ['HAS_SUBTYPE'] WHEN lower(trim(relation)) = 'related' THEN ['PART_OF', 'USES'] END AS kinds, confidence, reason FROM merge_decisions WHERE a IS NOT NULL AND b IS NOT NULL),
f AS (SELECT * FROM x WHERE coalesce(confidence, 0) BETWEEN 0 AND 1), o AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY item ORDER BY action NULLS FIRST, kinds NULLS FIRST, confidence NULLS FIRST, reason NULLS FIRST) = 1), c AS (SELECT item, string_agg(DISTINCT reason, ' ') AS evidence FROM x GROUP BY item)
SELECT c.item, CASE WHEN coalesce(len(kinds), 0) > 1 OR upper(coalesce(action, 'REVIEW')) NOT IN ('KEEP', 'REMOVE', 'RETYPE', 'REVERSE', 'MERGE', 'REVIEW') THEN 'REVIEW' ELSE upper(coalesce(action, 'REVIEW')) END AS action, CASE WHEN len(kinds) = 1 THEN kinds[1] END AS new_relation, coalesce(confidence, 0) AS confidence, coalesce(reason, '') <> '' AND regexp_matches(reason, '[^{S.SPACES}]') AS verified FROM c LEFT JOIN o USING (item)""")
def audit_decisions(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts on pairs of names as answers of an audit, made to fit what may be decided."""
    kind = F.lower(F.trim("relation"))
    x = table(spark, base, "merge_decisions").where("a IS NOT NULL AND b IS NOT NULL").select(
        F.concat("a", F.lit(" > "), "b").alias("item"), F.when(kind == "same", "merge").when(kind == "different", "KEEP").when(kind == "subset", "RETYPE").otherwise(F.col("relation")).alias("action"),
        F.when(kind == "subset", F.array(F.lit("HAS_SUBTYPE"))).when(kind == "related", F.array(F.lit("PART_OF"), F.lit("USES"))).alias("new_relations"), "confidence", F.col("reason").alias("quote"),
    )
    evidence = x.groupBy("item").agg(F.array_join(F.array_sort(F.collect_set("quote")), " ").alias("evidence"))
    return K.audit_decisions(evidence, x)


@query()
def direction_choice(spark: SparkSession, base: str) -> DataFrame:
    """Subtype edges stated in both directions with the score of each direction, and which one is kept."""
    names = V.concepts(spark, base, "name", "canonical_name", "short_definition", "chapter_id")
    c = names.select(F.col("name").alias("concept_id"), F.col("canonical_name").alias("name"), F.col("short_definition").alias("definition"), F.regexp_replace(F.lower("canonical_name"), " ", "_").alias("kind"), F.regexp_extract("chapter_id", "ch(\\d+)", 1).alias("section"))
    m = V.mentions(spark, base, "concept_id").join(names.select("concept_id", "name"), "concept_id").select(F.col("name").alias("concept_id"), "chunk_id")
    e = H.layer_edges(table(spark, base, "subtype_edges"), "HAS_SUBTYPE", "parent", "child").select(F.col("parent").alias("source"), F.col("child").alias("target"), F.col("layer").alias("relation"), F.array().cast("array<string>").alias("quotes"))
    return K.direction_scores(e, c, m).select("source", "target", "relation", F.round("score", 6).alias("score"), "kept")


@query(V.sql("g_concept", "g_chunk", "g_mention") + f""", k AS (SELECT chunk_id, chapter_id, primary_section, list_distinct(list_filter(coalesce(sections, []), lambda x: x IS NOT NULL)) AS ss, text FROM g_chunk), ks AS (SELECT chunk_id, chapter_id, primary_section, unnest(CASE WHEN len(ss) = 0 THEN [primary_section] ELSE ss END) AS section FROM k),
ms AS (SELECT DISTINCT m.concept_id, c.chapter_id, c.primary_section AS section, m.evidence_type FROM g_mention m JOIN g_chunk c USING (chunk_id) JOIN g_concept g ON g.concept_id = m.concept_id WHERE c.primary_section IS NOT NULL),
kp AS (SELECT DISTINCT chunk_id, concept_id, ks.section, ks.section = primary_section AS own FROM ks JOIN ms ON ms.chapter_id = ks.chapter_id AND ms.section = ks.section WHERE evidence_type = 'definition'),
a AS (SELECT chunk_id, concept_id, 100 + 20 * count_if(own) AS score FROM kp GROUP BY 1, 2), b AS (SELECT DISTINCT chunk_id, concept_id, 80 AS score FROM ks JOIN ms ON ms.chapter_id = ks.chapter_id AND ms.section = ks.section WHERE evidence_type IN ('example', 'usage')),
{_NAMED}, n AS (SELECT chunk_id, chapter_id, {_flat(S.search('text'))} AS f FROM g_chunk), l AS (SELECT DISTINCT chunk_id, g.concept_id, 120 AS score FROM n JOIN g_concept g ON g.chapter_id = n.chapter_id JOIN d ON d.concept_id = g.concept_id WHERE contains(f, {_flat('phrase')})),
u AS (SELECT chunk_id, concept_id, max(score)::INT AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM l) GROUP BY 1, 2)
SELECT chunk_id, concept_id, score FROM u JOIN g_concept USING (concept_id) QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY score DESC, canonical_name DESC NULLS LAST, concept_id) <= 24""")
def chapter_candidates(spark: SparkSession, base: str) -> DataFrame:
    """The 24 best concepts of each chunk within its chapter: defined in its sections, used there, or named in its text."""
    c = spread(stored(V.concepts(spark, base, "canonical_name", "aliases", "chapter_id").select("concept_id", "canonical_name", "chapter_id", _names().alias("names")), "concepts"))
    k = stored(V.chunks(spark, base, "chapter_id", "primary_section", "sections", "text"), "chunks")
    where = k.select("chunk_id", "chapter_id", F.col("primary_section").alias("section")).where("section IS NOT NULL")
    m = V.mentions(spark, base, "evidence_type").join(where, "chunk_id").select("concept_id", "chapter_id", "section", "evidence_type").distinct()
    points = m.where("evidence_type = 'definition'").select("concept_id", "chapter_id", "section").distinct()
    used = m.where("evidence_type IN ('example', 'usage')").select("concept_id", "chapter_id", "section").distinct()
    return C.chapter_candidates(k, points, used, c, 24)


@query()
def structure_typing(spark: SparkSession, base: str) -> DataFrame:
    """Types of subtype edges. Categories are the names that have five children or more; no type is forced."""
    e = table(spark, base, "subtype_edges")
    names = V.concepts(spark, base, "name", "short_definition", "aliases").select("name", F.col("short_definition").alias("definition"), "aliases")
    categories = e.where("parent IS NOT NULL AND child IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.countDistinct("child").alias("n")).where("n >= 5")
    forced = spark.createDataFrame([], "parent string, child string, relation string, confidence double")
    return R.structure_types(e, names, categories, forced)
