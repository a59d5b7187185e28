"""Queries on candidates, alignment, validation and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aliases as A
from ..operators import candidates as C
from ..operators import gates
from ..operators import graph as G
from ..operators import validate as K
from ..session import stored, table
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()

_ALL = "list_concat([canonical_name], coalesce(aliases, []))"


def _names(name: str = "canonical_name"):
    return F.concat(F.array(name), F.coalesce("aliases", F.array().cast("array<string>")))


def _local(spark: SparkSession, base: str) -> DataFrame:
    c = V.concepts(spark, base)
    return c.select(F.concat(F.lit("L"), "concept_id").alias("local_id"), F.concat(F.lower("canonical_name"), F.lit("s")).alias("name"), F.array().cast("array<string>").alias("aliases"), F.lit("1.1").alias("section"), F.col("short_definition").alias("definition"), F.col("chapter_id").alias("chapter"))


def _registry(spark: SparkSession, base: str) -> DataFrame:
    return V.concepts(spark, base).select("concept_id", "canonical_name", "aliases", "short_definition", F.array(F.lit("1")).alias("sections"), F.col("chapter_id").alias("chapter"))


@query(V.sql("g_concept") + f", g AS (SELECT concept_id, unnest({_ALL}) AS n FROM g_concept), k AS (SELECT DISTINCT concept_id, unnest([{S.name('n')}, {S.name('n', True)}]) AS k FROM g), a AS (SELECT DISTINCT 'L' || concept_id AS local_id, unnest([{S.name('lower(canonical_name) || ' + chr(39) + 's' + chr(39))}, {S.name('lower(canonical_name) || ' + chr(39) + 's' + chr(39), True)}]) AS k FROM g_concept) SELECT local_id, count(DISTINCT concept_id) AS hits FROM a JOIN k USING (k) WHERE k <> '' GROUP BY local_id")
def align_exact(spark: SparkSession, base: str) -> DataFrame:
    """Names in the plural that find their concept by key."""
    g = V.concepts(spark, base).select("concept_id", F.explode(_names()).alias("n")).select("concept_id", F.explode(T.name_keys("n")).alias("k")).distinct()
    a = _local(spark, base).select("local_id", F.explode(T.name_keys("name")).alias("k")).distinct()
    return a.join(g, "k").groupBy("local_id").agg(F.countDistinct("concept_id").alias("hits"))


@query()
def align_all(spark: SparkSession, base: str) -> DataFrame:
    """Every local name with its concept, or UNMAPPED."""
    return C.align(_local(spark, base), _registry(spark, base))


@query()
def align_report(spark: SparkSession, base: str) -> DataFrame:
    """Local names by method of alignment."""
    return C.align(_local(spark, base), _registry(spark, base)).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


@query(V.sql("g_concept") + f""", h AS (SELECT DISTINCT regexp_extract(short_definition, '^An? (.+?) that ', 1) AS h FROM g_concept), x AS (SELECT h FROM h WHERE h <> '' UNION SELECT split_part(h, ' ', 1) || ' kernel ' || split_part(h, ' ', 2) FROM h WHERE contains(h, ' ')),
w AS (SELECT h, list_filter(list_distinct(string_split({S.name('h', True)}, ' ')), lambda t: t <> '' AND t NOT IN ('the', 'a', 'an', 'of', 'and', 'for', 'to')) AS ws FROM x) SELECT p.h AS part, q.h AS whole FROM w p JOIN w q ON p.h <> q.h AND len(p.ws) >= 2 AND len(q.ws) >= 2 AND len(list_intersect(p.ws, q.ws)) = len(p.ws)""")
def gap_near_duplicates(spark: SparkSession, base: str) -> DataFrame:
    """Names all of whose words another name has."""
    h = V.concepts(spark, base).select(F.regexp_extract("short_definition", "^An? (.+?) that ", 1).alias("h")).where("h <> ''").distinct()
    first, second = (F.split_part("h", F.lit(" "), F.lit(n)) for n in (1, 2))
    x = h.union(h.where(F.contains("h", F.lit(" "))).select(F.concat(first, F.lit(" kernel "), second))).distinct()
    return C.near_duplicates(x, "h", "h", "the a an of and for to".split())


_NAMED = f"""d AS (SELECT DISTINCT concept_id, phrase FROM (SELECT concept_id, {S.name('n')} AS phrase FROM (SELECT concept_id, unnest({_ALL}) AS n FROM g_concept)) WHERE length(phrase) >= 3),
t AS (SELECT chunk_id, chapter_id, text, {S.search('text')} AS t FROM g_chunk),
e AS (SELECT chunk_id, concept_id, max(len(string_split(phrase, ' '))) AS words FROM t JOIN d ON contains(t.t, phrase) AND regexp_matches(t.t, '(^|[^a-z0-9])' || regexp_escape(phrase) || '([^a-z0-9]|$)') GROUP BY 1, 2)"""


def _named(spark: SparkSession, base: str) -> DataFrame:
    return V.concepts(spark, base, "canonical_name", "aliases", "short_definition").select("concept_id", "short_definition", _names().alias("names"))


@query(V.sql("g_concept", "g_chunk") + f", {_NAMED} SELECT chunk_id, concept_id FROM e")
def lexical_hits(spark: SparkSession, base: str) -> DataFrame:
    """Every concept that a chunk names, by its canonical name or an alias."""
    return C.named_concepts(V.chunks(spark, base, "text"), "chunk_id", "text", _named(spark, base)).select("chunk_id", "concept_id")


@query(V.sql("g_concept", "g_chunk") + f""", {_NAMED}, s AS (SELECT chunk_id, unnest({S.content('text', T.CANDIDATE_STOPS, 3)}) AS w FROM g_chunk), m AS (SELECT concept_id, {S.content('short_definition', T.CANDIDATE_STOPS, 4)} AS ws FROM g_concept), i AS (SELECT concept_id, len(ws) AS total, unnest(ws) AS w FROM m),
l AS (SELECT chunk_id, concept_id, count(*) AS n, any_value(total) AS total FROM s JOIN i USING (w) GROUP BY 1, 2 HAVING count(*) >= 2),
u AS (SELECT chunk_id, concept_id, round(1000.0::DOUBLE + 25 * words, 6) AS score FROM e UNION ALL SELECT chunk_id, concept_id, round(200.0::DOUBLE + 20 * n + 100.0::DOUBLE * n / total, 6) FROM l ANTI JOIN e USING (chunk_id, concept_id))
SELECT chunk_id, concept_id, score FROM u QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY score DESC, concept_id) <= 24""")
def candidate_concepts(spark: SparkSession, base: str) -> DataFrame:
    """The 24 best concepts for each chunk, every concept scored by its names or by the words of its own definition."""
    return C.best_content(V.chunks(spark, base, "text"), "chunk_id", "text", _named(spark, base), 24)


@query(V.sql("g_concept", "g_chunk") + f", {_NAMED} SELECT chunk_id, count(*) AS states FROM e JOIN t USING (chunk_id) WHERE regexp_matches(text, '(?i)\\b(fig|tab)\\. ') GROUP BY chunk_id HAVING count(*) >= 2")
def diagram_candidates(spark: SparkSession, base: str) -> DataFrame:
    """Chunks with a figure that name two concepts or more."""
    k = V.chunks(spark, base, "text").where(F.col("text").rlike("(?i)\\b(fig|tab)\\. "))
    return C.named_concepts(k, "chunk_id", "text", _named(spark, base)).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("states")).where("states >= 2")


@query(V.sql("g_concept", "g_chunk", "g_mention") + f", {_NAMED}, p AS (SELECT DISTINCT chunk_id, 100 AS preferred FROM g_mention WHERE evidence_type = 'definition'), h AS (SELECT chunk_id, count(*) AS n FROM e GROUP BY chunk_id)"
 + " SELECT chapter_id, chunk_id, coalesce(preferred, 0) + coalesce(n, 0) AS score FROM t LEFT JOIN p USING (chunk_id) LEFT JOIN h USING (chunk_id) QUALIFY row_number() OVER (PARTITION BY chapter_id ORDER BY score DESC, chunk_id) <= 2")
def audit_evidence(spark: SparkSession, base: str) -> DataFrame:
    """The two best chunks of each chapter for an audit: with a definition first, then by concepts named."""
    from ..operators.merge import top_per_key

    k = V.chunks(spark, base, "chapter_id", "text")
    preferred = V.mentions(spark, base, "evidence_type").where("evidence_type = 'definition'").select("chunk_id").distinct().withColumn("p", F.lit(100))
    named = C.named_concepts(k, "chunk_id", "text", _named(spark, base)).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))
    s = k.select("chapter_id", "chunk_id").join(preferred, "chunk_id", "left").join(named, "chunk_id", "left").select("chapter_id", "chunk_id", (F.coalesce("p", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("score"))
    return top_per_key(s, ["chapter_id"], [F.desc("score"), "chunk_id"], 2).drop("place")



@query(V.sql("g_concept", "g_mention") + """, s AS (SELECT concept_id, book_id, chapter_num FROM g_concept JOIN chapters USING (chapter_id)), u AS (SELECT a.concept_id AS a, b.concept_id AS b, true AS near, 0 AS shared FROM s a JOIN s b ON a.book_id = b.book_id AND a.concept_id < b.concept_id AND abs(a.chapter_num - b.chapter_num) <= 3
UNION ALL SELECT x.concept_id, y.concept_id, false, count(DISTINCT x.chunk_id) FROM g_mention x JOIN g_mention y ON x.chunk_id = y.chunk_id AND x.concept_id < y.concept_id GROUP BY 1, 2) SELECT a, b, bool_or(near) AS near, max(shared)::BIGINT AS shared FROM u GROUP BY a, b""")
def gen1_candidate_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of concepts of one book at most three chapters apart, or with a chunk in common, and how many they share."""
    s = V.concepts(spark, base, "chapter_id").join(table(spark, base, "chapters").select("chapter_id", "book_id", "chapter_num"), "chapter_id").select("concept_id", "book_id", "chapter_num")
    near = s.select(F.col("concept_id").alias("b"), "book_id", F.explode(F.sequence(F.col("chapter_num") - 3, F.col("chapter_num") + 3)).alias("chapter_num"))
    close = s.withColumnRenamed("concept_id", "a").join(near, ["book_id", "chapter_num"]).where("a < b").select("a", "b", F.lit(True).alias("near"), F.lit(0).cast("long").alias("shared"))
    m = V.mentions(spark, base, "concept_id").select("concept_id", "chunk_id").distinct()
    both = m.withColumnRenamed("concept_id", "a").join(m.withColumnRenamed("concept_id", "b"), "chunk_id").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    return close.union(both.select("a", "b", F.lit(False), "shared")).groupBy("a", "b").agg(F.bool_or("near").alias("near"), F.max("shared").alias("shared"))


@query(V.sql("g_relation", "g_mention") + """, q AS (SELECT source_concept_id AS a, target_concept_id AS b, unnest(evidence) AS e FROM g_relation), f AS (SELECT least(a, b) AS a, greatest(a, b) AS b, e.chunk_id AS chunk_id, 0 AS pri FROM q WHERE a <> b), p AS (SELECT DISTINCT a, b FROM f),
s AS (SELECT DISTINCT p.a, p.b, x.chunk_id, 1 AS pri FROM p JOIN g_mention x ON x.concept_id = p.a JOIN g_mention y ON y.concept_id = p.b AND y.chunk_id = x.chunk_id), u AS (SELECT a, b, chunk_id, min(pri) AS pri FROM (SELECT * FROM f UNION ALL SELECT * FROM s) WHERE chunk_id IS NOT NULL GROUP BY 1, 2, 3)
SELECT a, b, chunk_id, pri FROM u QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY pri, chunk_id) <= 3""")
def pair_context(spark: SparkSession, base: str) -> DataFrame:
    """Three chunks for each related pair: of the relation first, then shared ones."""
    from ..operators.merge import top_per_key

    r = V.relations(spark, base).where("source_concept_id <> target_concept_id")
    f = r.select(F.least("source_concept_id", "target_concept_id").alias("a"), F.greatest("source_concept_id", "target_concept_id").alias("b"), F.explode("evidence.chunk_id").alias("chunk_id")).withColumn("pri", F.lit(0))
    m = stored(V.mentions(spark, base, "concept_id", "chunk_id").select("concept_id", "chunk_id").distinct(), "named")
    shared = C.shared_chunks(f.select("a", "b").distinct(), m).withColumn("pri", F.lit(1))
    u = f.union(shared).where("chunk_id IS NOT NULL").groupBy("a", "b", "chunk_id").agg(F.min("pri").alias("pri"))
    return top_per_key(u, ["a", "b"], ["pri", "chunk_id"], 3).drop("place")


_PRE = "p AS (SELECT prereq AS source, target, max(confidence) AS confidence FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2)"


@query("WITH RECURSIVE c AS (SELECT concept_id FROM concepts WHERE concept_id IS NOT NULL), k AS (SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL), rel AS (SELECT * FROM relations), " + _PRE + """, e AS (SELECT source, target FROM p), fwd(s, t) AS (SELECT source, target FROM e UNION SELECT f.s, e.target FROM fwd f JOIN e ON e.source = f.t), lp AS (SELECT s FROM fwd WHERE s = t),
core AS (SELECT DISTINCT t AS node FROM fwd WHERE s IN (SELECT s FROM lp) INTERSECT SELECT DISTINCT s FROM fwd WHERE t IN (SELECT s FROM lp))
SELECT DISTINCT rule, coalesce(key, '') AS key FROM (
SELECT 'duplicate concept_id' AS rule, concept_id AS key FROM c GROUP BY concept_id HAVING count(*) > 1
UNION ALL SELECT 'non-global concept_id', concept_id FROM c WHERE NOT starts_with(concept_id, 'OS_')
UNION ALL SELECT 'duplicate chunk_id', chunk_id FROM k GROUP BY chunk_id HAVING count(*) > 1
UNION ALL SELECT 'dangling mention concept', mention_id::VARCHAR FROM mentions WHERE concept_id IS NULL OR concept_id NOT IN (SELECT concept_id FROM c)
UNION ALL SELECT 'dangling mention chunk', mention_id::VARCHAR FROM mentions WHERE chunk_id IS NULL OR chunk_id NOT IN (SELECT chunk_id FROM k)
UNION ALL SELECT 'dangling relation endpoint', relation_id::VARCHAR FROM rel WHERE source_concept_id IS NULL OR target_concept_id IS NULL OR source_concept_id NOT IN (SELECT concept_id FROM c) OR target_concept_id NOT IN (SELECT concept_id FROM c)
UNION ALL SELECT 'self relation', relation_id::VARCHAR FROM rel WHERE source_concept_id = target_concept_id
UNION ALL SELECT 'unsupported relation type', relation_id::VARCHAR FROM rel WHERE upper(coalesce(relation, '')) NOT IN (""" + ", ".join(f"'{r}'" for r in K.RELATIONS) + """)
UNION ALL SELECT 'duplicate relation', concat_ws(' > ', source_concept_id, upper(relation), target_concept_id) FROM rel GROUP BY source_concept_id, upper(relation), target_concept_id HAVING count(*) > 1
UNION ALL SELECT 'self prerequisite', source || ' > ' || target FROM p WHERE source = target
UNION ALL SELECT 'prerequisite below confidence', source || ' > ' || target FROM p WHERE coalesce(confidence, 0) < 0.85
UNION ALL SELECT 'cyclic prerequisite layer', source || ' > ' || target FROM p WHERE source IN (SELECT node FROM core) AND target IN (SELECT node FROM core))""")
def import_contract_violations(spark: SparkSession, base: str) -> DataFrame:
    """All violations of the import contract in the main tables and the prerequisite edges, with repeated deliveries as duplicates."""
    p = table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL").groupBy(F.col("prereq").alias("source"), "target").agg(F.max("confidence").alias("confidence"))
    edge = F.concat_ws(" > ", "source", "target").alias("key")
    flags = F.array(F.when(F.col("source") == F.col("target"), "self prerequisite"), F.when(F.coalesce("confidence", F.lit(0.0)) < K.PREREQUISITE_FLOOR, "prerequisite below confidence"))
    layer = p.select(F.explode(F.array_compact(flags)).alias("rule"), edge).union(G.cyclic_core(p).select(F.lit("cyclic prerequisite layer"), edge))
    concepts, chunks = (table(spark, base, n).where(f"{k} IS NOT NULL").select(k) for n, k in (("concepts", "concept_id"), ("chunks", "chunk_id")))
    return gates.import_errors(concepts, chunks, table(spark, base, "mentions"), table(spark, base, "relations")).union(layer)


@query(V.sql("g_concept", "g_chunk", "g_mention") + f""", n AS (SELECT m.*, k.text, c.concept_id IS NOT NULL AS known, {_ALL.replace('canonical_name', 'c.canonical_name').replace('aliases', 'c.aliases')} AS names, c.short_definition,
 {S.search('m.quote')} AS q, {S.words(S.name('m.quote', True))} AS qw, {S.jaccard(S.content('m.quote', T.DEFINITION_STOPS, 3), S.content('c.short_definition', T.DEFINITION_STOPS, 3))} AS overlap FROM g_mention m LEFT JOIN g_chunk k USING (chunk_id) LEFT JOIN g_concept c ON c.concept_id = m.concept_id),
w AS (SELECT *, coalesce(len(list_filter(list_transform(names, lambda x: {S.name('x')}), lambda z: z <> '' AND contains(' ' || regexp_replace(q, '[^a-z0-9]', ' ', 'g') || ' ', ' ' || regexp_replace(z, '[^a-z0-9]', ' ', 'g') || ' '))) > 0, false) AS named,
 coalesce(list_max(list_transform(list_transform(names, lambda x: list_filter({S.words(S.name('x', True))}, lambda y: length(y) > 2 AND y NOT IN ({", ".join(f"'{s}'" for s in T.ANCHOR_STOPS)}))), lambda ws: CASE WHEN len(ws) >= 2 AND len(list_intersect(ws, qw)) >= 2 THEN len(list_intersect(ws, qw))::DOUBLE / len(ws) ELSE 0.0 END)), 0.0) AS coverage FROM n),
z AS (SELECT mention_id, CASE WHEN NOT known THEN 'unknown_or_non_candidate_concept' WHEN evidence_type IS NULL THEN 'invalid_evidence_type' WHEN NOT {S.quote_in('quote', 'text')} THEN 'quote_not_found_in_chunk'
WHEN confidence < CASE evidence_type WHEN 'definition' THEN 0.75 WHEN 'mention' THEN 0.75 ELSE 0.7 END THEN 'below_evidence_confidence_threshold' WHEN NOT (named OR coverage >= 0.67 OR (evidence_type = 'definition' AND overlap >= 0.18)) THEN 'quote_not_anchored_to_concept_name_alias_or_definition' WHEN evidence_type = 'definition' AND NOT coalesce(overlap >= 0.18, false) THEN 'definition_not_confirmed_by_model' END AS reason, concept_id, chunk_id, evidence_type, {S.normal_text('quote')} AS nq FROM w)
SELECT mention_id, reason, reason IS NULL AND row_number() OVER (PARTITION BY concept_id, chunk_id, evidence_type, nq, reason IS NULL ORDER BY mention_id) = 1 AS kept FROM z""")
def evidence_validation(spark: SparkSession, base: str) -> DataFrame:
    """Why each mention is refused, or null, and whether it is the first of its kind. A definition is confirmed by its overlap with the registry's."""
    c = V.concepts(spark, base, "canonical_name", "aliases", "short_definition").select("concept_id", T.anchor_terms(_names(), "short_definition").alias("terms"), "short_definition", F.lit(True).alias("k"))
    k = V.chunks(spark, base, "text").select("chunk_id", T.normalize_text("text").alias("normal_text"))
    # Texts are met once and leave at once; only narrow rows meet the concepts, where one key may be hot.
    m = V.mentions(spark, base, "quote", "evidence_type", "confidence").join(k, "chunk_id", "left")
    m = m.withColumn("found", F.coalesce(T.quote_in_normal(T.normalize_text("quote"), F.col("normal_text")), F.lit(False))).drop("normal_text")
    m = m.join(c, "concept_id", "left").withColumn("known", F.coalesce("k", F.lit(False))).withColumn("matches_definition", T.definition_overlap("quote", "short_definition") >= T.OVERLAP_FLOOR)
    return K.evidence_reasons(m).select("mention_id", "reason", "kept")


_TYPES = ", ".join(f"'{r}'" for r in K.RELATIONS)


_ACTION = "CASE verification_status WHEN 'VERIFIED' THEN 'ACCEPT' WHEN 'VERIFIED_REVERSED' THEN 'REVERSE' WHEN 'VERIFIED_RETYPED' THEN 'RETYPE' ELSE 'DROP' END"


@query(V.sql("g_relation") + f""", d AS (SELECT *, {_ACTION} AS action, CASE WHEN relation = 'USES' THEN 'INVOKES' ELSE relation END AS new_type FROM g_relation), x AS (SELECT relation_id, CASE WHEN action = 'REVERSE' THEN target_concept_id ELSE source_concept_id END AS s, CASE WHEN action = 'REVERSE' THEN source_concept_id ELSE target_concept_id END AS t, CASE WHEN action = 'RETYPE' THEN new_type ELSE relation END AS relation FROM d WHERE action IN ('ACCEPT', 'REVERSE') OR (action = 'RETYPE' AND coalesce(new_type, '') IN ({_TYPES})))
SELECT relation_id, CASE WHEN relation = 'CONTRASTED_WITH' THEN least(s, t) ELSE s END AS source, CASE WHEN relation = 'CONTRASTED_WITH' THEN greatest(s, t) ELSE t END AS target, relation FROM x""")
def apply_verification(spark: SparkSession, base: str) -> DataFrame:
    """K4: relations after the decisions on them."""
    r = V.relations(spark, base)
    status = F.col("verification_status")
    action = F.when(status == "VERIFIED", "ACCEPT").when(status == "VERIFIED_REVERSED", "REVERSE").when(status == "VERIFIED_RETYPED", "RETYPE").otherwise("DROP")
    d = r.select("relation_id", action.alias("action"), F.when(F.col("relation") == "USES", "INVOKES").otherwise(F.col("relation")).alias("new_type"))
    return K.decide(r.select("relation_id", F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation"), d)


@query(V.sql("g_concept", "g_mention") + ", d AS (SELECT concept_id, bool_or(evidence_type = 'definition' AND confidence >= 0.75) AS defined FROM g_mention GROUP BY 1) SELECT concept_id, upper(trim(status)) = 'APPROVED' OR coalesce(defined, false) AS formal FROM g_concept LEFT JOIN d USING (concept_id)".replace("upper(trim(status)) = 'APPROVED'", "coalesce(upper(trim(status)) = 'APPROVED', false)"))
def formal_promotion(spark: SparkSession, base: str) -> DataFrame:
    """Concepts that are formal by state or by a definition."""
    d = V.mentions(spark, base, "evidence_type", "confidence").groupBy("concept_id").agg(F.bool_or((F.col("evidence_type") == "definition") & (F.col("confidence") >= 0.75)).alias("defined"))
    ok = F.coalesce(F.upper(F.trim("status")) == "APPROVED", F.lit(False)) | F.coalesce("defined", F.lit(False))
    return V.concepts(spark, base).join(d, "concept_id", "left").select("concept_id", ok.alias("formal"))


@query("SELECT 'no chapter' AS gate, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM chapters c WHERE c.chapter_id = d.chapter_id) UNION ALL SELECT 'no section', count(*) FROM documents WHERE NOT regexp_matches(coalesce(primary_section, ''), '[^{0}]') UNION ALL SELECT 'no text', count(*) FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '[^{0}]')".replace("{0}", S.SPACES))
def bridge_gates(spark: SparkSession, base: str) -> DataFrame:
    """Documents that lack what a build needs."""
    d = table(spark, base, "documents")
    no = lambda df, gate: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(gate).alias("gate"), "n")
    blank = lambda c: ~F.coalesce(F.col(c), F.lit("")).rlike(f"[^{T.SPACES}]")
    return no(d.join(table(spark, base, "chapters"), "chapter_id", "left_anti"), "no chapter").union(no(d.where(blank("primary_section")), "no section")).union(no(d.where(blank("text")), "no text"))


# Words of a reason that tell a kind of relation, in order.
REASONS = [
    ("CREATES_OR_RESULTS_IN", ["creates", "created by", "建立", "創建", "產生", "結果", "導致", "return value", "回傳值", "responsible for"]),
    ("USES", ["parameter", "參數", "需要", "使用", "uses", "used by", "呼叫", "called", "invoke", "passed", "waits for", "等待"]),
    ("HAS_FIELD", ["member", "field", "contains", "包含", "成員", "欄位"]),
    ("HAS_COMPONENT", ["組成", "component", "part of", "核心組件", "一部分"]),
    ("IS_A", ["is a", "是一種", "具體類型", "specific instance", "specific type", "特定類型"]),
]


@query("SELECT relation_id, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(coalesce(verification_reason, {chr(39) * 2})), {chr(39)}{w}{chr(39)})' for w in ws)} THEN '{k}'" for k, ws in REASONS) + " ELSE 'PREREQ_OF' END AS kind, count(*) AS n FROM relations GROUP BY ALL")
def relation_typing(spark: SparkSession, base: str) -> DataFrame:
    """R2: kinds of relations by the words of their reasons."""
    reason = F.coalesce("verification_reason", F.lit(""))
    out = None
    for kind, words in REASONS:
        hit = C.any_of(words, reason)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return table(spark, base, "relations").groupBy("relation_id", out.otherwise("PREREQ_OF").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT a, b, confidence, CASE WHEN lower(trim(relation)) = 'same' AND confidence >= 0.85 THEN 'MERGE' WHEN lower(trim(relation)) = 'subset' AND confidence >= 0.85 AND parent IS NOT NULL AND child IS NOT NULL THEN 'SUBTYPE' ELSE 'KEEP' END AS action, count(*) AS n FROM merge_decisions GROUP BY ALL")
def merge_actions(spark: SparkSession, base: str) -> DataFrame:
    """What a decision on two names leads to."""
    verdict, sure = F.lower(F.trim("relation")), F.col("confidence") >= 0.85
    action = F.when((verdict == "same") & sure, "MERGE").when((verdict == "subset") & sure & F.col("parent").isNotNull() & F.col("child").isNotNull(), "SUBTYPE").otherwise("KEEP")
    return table(spark, base, "merge_decisions").groupBy("a", "b", "confidence", action.alias("action")).agg(F.count(F.lit(1)).alias("n"))


def _stated(pattern: str) -> str:
    found = "'" + pattern.replace("'", "''") + "'"
    return f"SELECT chunk_id, unnest(regexp_extract_all(text, {found}, 1)) AS a, unnest(regexp_extract_all(text, {found}, 2)) AS b FROM g_chunk WHERE text IS NOT NULL"


_ACRONYM = "length(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g')) BETWEEN 1 AND 12 AND upper(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g')) = regexp_replace({0}, '[^A-Za-z0-9]', '', 'g')"


@query(V.sql("g_concept", "g_chunk") + f", p AS ({' UNION ALL '.join(map(_stated, A.STATEMENTS))}), n AS (SELECT canonical_name AS name, true AS core FROM g_concept WHERE canonical_name IS NOT NULL UNION ALL SELECT unnest(aliases), false FROM g_concept), k AS (SELECT lower({S.squeeze('name')}) AS k, min(name) AS name, bool_or(core) AS core FROM n WHERE name IS NOT NULL GROUP BY 1),"
 + f" j AS (SELECT x.name AS na, y.name AS nb, (x.core, NOT ({_ACRONYM.format('x.name')}), length(x.name)) AS ra, (y.core, NOT ({_ACRONYM.format('y.name')}), length(y.name)) AS rb, chunk_id FROM p JOIN k x ON x.k = lower({S.squeeze('a')}) JOIN k y ON y.k = lower({S.squeeze('b')}) WHERE x.k <> y.k)"
 + " SELECT CASE WHEN ra > rb OR (ra = rb AND na < nb) THEN na ELSE nb END AS canonical, CASE WHEN ra > rb OR (ra = rb AND na < nb) THEN nb ELSE na END AS alias, min(chunk_id) AS seen_in FROM j GROUP BY 1, 2")
def alias_patterns(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of known names that chunks state to mean one thing."""
    c = V.concepts(spark, base, "canonical_name", "aliases")
    names = c.select(F.col("canonical_name").alias("name"), F.lit(True).alias("core")).union(c.select(F.explode("aliases"), F.lit(False))).where("name IS NOT NULL")
    return A.stated_aliases(V.chunks(spark, base, "text"), "chunk_id", "text", names)


@query("""WITH al AS (SELECT child AS alias, min(parent) AS canonical FROM subtype_edges WHERE child IS NOT NULL AND parent IS NOT NULL AND child <> parent GROUP BY child), n AS (SELECT DISTINCT x AS name FROM (SELECT unnest([parent, child]) AS x FROM subtype_edges) WHERE x IS NOT NULL),
m AS (SELECT coalesce(canonical, name) AS target, CASE WHEN canonical IS NOT NULL THEN name END AS extra FROM n LEFT JOIN al ON alias = name) SELECT target AS name, coalesce(array_to_string(list_sort(list_distinct(list(extra) FILTER (extra IS NOT NULL AND extra <> target))), '|'), '') AS aliases FROM m GROUP BY target""")
def alias_fold(spark: SparkSession, base: str) -> DataFrame:
    """Children of a hierarchy folded into their first parent as aliases."""
    s = table(spark, base, "subtype_edges")
    al = s.where("child IS NOT NULL AND parent IS NOT NULL AND child <> parent").groupBy(F.col("child").alias("alias")).agg(F.min("parent").alias("canonical"))
    n = s.select(F.explode(F.array("parent", "child")).alias("name")).where("name IS NOT NULL").distinct()
    out = A.fold(n.select("name", F.array().cast("array<string>").alias("aliases"), F.lit("").alias("definition")), al)
    return out.select("name", F.array_join("aliases", "|").alias("aliases"))


@query(V.sql("g_concept") + ", x AS (SELECT DISTINCT canonical_name AS n FROM g_concept UNION SELECT DISTINCT p_name FROM part), e AS (SELECT 'red widget' AS n, 'RedWidgetUnit' AS c) SELECT x.n AS name, coalesce(c, array_to_string(list_transform(list_filter(string_split(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(x.n, '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Za-z])([0-9])', '\\1 \\2', 'g')), '[^A-Za-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: upper(w[1]) || substr(w, 2)), '')) AS canonical FROM x LEFT JOIN e ON e.n = x.n WHERE x.n IS NOT NULL")
def canonical_spellings(spark: SparkSession, base: str) -> DataFrame:
    """Canonical spellings by a map and by rule."""
    x = V.concepts(spark, base).select(F.col("canonical_name").alias("name")).union(table(spark, base, "part").select("p_name")).where("name IS NOT NULL").distinct()
    exact = spark.createDataFrame([("red widget", "RedWidgetUnit")], "name string, canonical string")
    return A.canonical_names(x, "name", exact).select("name", "canonical")
