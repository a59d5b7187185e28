"""Queries on aggregations, deduplication, windows and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import merge as M
from ..session import table
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()

_SPLIT = "2024-07-01"


@query(V.sql("g_mention") + """, o AS (SELECT chunk_id, concept_id, list(quote ORDER BY mention_id) AS qs, list(evidence_type ORDER BY mention_id) AS ts, max(confidence) AS c, count(*) AS n FROM g_mention GROUP BY ALL)
SELECT chunk_id, concept_id, md5(array_to_string(list_filter(qs, lambda x, i: x IS NOT NULL AND list_position(qs, x) = i), '|')) AS quotes, array_to_string(list_filter(ts, lambda x, i: x IS NOT NULL AND list_position(ts, x) = i), '|') AS types, round(c, 6) AS confidence, n FROM o""")
def mention_merge(spark: SparkSession, base: str) -> DataFrame:
    """One row per chunk and concept, quotes and types in order of arrival."""
    m = V.mentions(spark, base).groupBy("chunk_id", "concept_id")
    quotes, types = (F.array_join(M.ordered_distinct(F.col(c), F.col("mention_id")), "|") for c in ("quote", "evidence_type"))
    return m.agg(F.md5(quotes).alias("quotes"), types.alias("types"), F.round(F.max("confidence"), 6).alias("confidence"), F.count(F.lit(1)).alias("n"))


@query(V.sql("g_mention") + f", k AS (SELECT mention_id, concept_id, chunk_id, evidence_type, {S.normal_text('quote')} AS q FROM g_mention) SELECT concept_id, chunk_id, evidence_type, md5(q) AS quote_key, min(mention_id) AS mention_id, count(*) AS n FROM k GROUP BY ALL")
def mention_dedup(spark: SparkSession, base: str) -> DataFrame:
    """A3: mentions that say the same in the same chunk, once."""
    m = V.mentions(spark, base)
    return m.groupBy("concept_id", "chunk_id", "evidence_type", F.md5(T.normalize_text("quote")).alias("quote_key")).agg(F.min("mention_id").alias("mention_id"), F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT p_name AS name, p_type AS category, p_brand AS alias, p_partkey AS arrival, 'A ' || p_name || ' of type ' || p_type || ' by ' || p_brand AS definition, p_size > 40 AS flag, p_retailprice AS confidence FROM part), k AS (SELECT *, replace(lower(trim(name)), ' ', '') AS key FROM p)
SELECT key AS concept_key, arg_min(name, arrival) AS name, arg_max(definition, (length(definition), -arrival)) AS definition, arg_min(category, arrival) AS category, bool_or(flag) AS flag, max(confidence) AS confidence, array_to_string(list_sort(list_distinct(list(alias))), '|') AS aliases FROM k GROUP BY key""")
def concept_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Parts of one name as one record."""
    p = table(spark, base, "part").select(
        F.col("p_name").alias("name"), F.concat(F.lit("A "), "p_name", F.lit(" of type "), "p_type", F.lit(" by "), "p_brand").alias("definition"), F.array("p_brand").alias("aliases"),
        F.col("p_type").alias("category"), (F.col("p_size") > 40).alias("flag"), F.col("p_retailprice").alias("confidence"), F.col("p_partkey").alias("arrival"),
    )
    return M.dedup_concepts(p, T.spaceless_key(F.col("name"))).withColumn("aliases", F.array_join("aliases", "|"))


@query(V.sql("g_relation") + f""", f AS (SELECT CASE WHEN relation = 'CONTRASTED_WITH' THEN least(source_concept_id, target_concept_id) ELSE source_concept_id END AS source, CASE WHEN relation = 'CONTRASTED_WITH' THEN greatest(source_concept_id, target_concept_id) ELSE target_concept_id END AS target, relation, confidence, evidence FROM g_relation WHERE relation IS NOT NULL),
n AS (SELECT source, target, relation, round(max(confidence), 4) AS confidence_max, round(avg(confidence), 4) AS confidence_mean, count(*) AS n_rows FROM f GROUP BY 1, 2, 3),
q AS (SELECT DISTINCT source, target, relation, e.chunk_id AS chunk_id, {S.normal_text('e.quote')} AS q FROM (SELECT source, target, relation, unnest(evidence) AS e FROM f)),
p AS (SELECT source, target, relation, count(*) AS evidence_count, array_to_string(list_sort(list_distinct(list(chunk_id))), '|') AS source_chunks FROM q GROUP BY 1, 2, 3)
SELECT n.*, coalesce(evidence_count, 0) AS evidence_count, coalesce(source_chunks, '') AS source_chunks FROM n LEFT JOIN p USING (source, target, relation)""")
def relation_aggregate(spark: SparkSession, base: str) -> DataFrame:
    """A2: relations by ends and type with their evidence."""
    r = V.relations(spark, base).where("relation IS NOT NULL").select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation", "confidence", "evidence")
    return M.aggregate_relations(r, ["CONTRASTED_WITH"])


@query(V.sql("g_mention") + """SELECT concept_id, bool_or((evidence_type = 'definition' AND confidence >= 0.75) OR (evidence_type IN ('example', 'usage') AND confidence >= 0.8)) AS strong, count_if(evidence_type = 'definition') AS definition, count_if(evidence_type = 'example') AS example, count_if(evidence_type = 'usage') AS usage, count_if(evidence_type = 'mention') AS mention FROM g_mention WHERE evidence_type IS NOT NULL GROUP BY concept_id""")
def evidence_strength(spark: SparkSession, base: str) -> DataFrame:
    """A4, A5: counts of evidence by type and whether any is strong."""
    kind, sure = F.col("evidence_type"), F.col("confidence")
    strong = ((kind == "definition") & (sure >= 0.75)) | (kind.isin("example", "usage") & (sure >= 0.8))
    counts = [F.count_if(kind == k).alias(k) for k in ("definition", "example", "usage", "mention")]
    return V.mentions(spark, base, "evidence_type", "confidence").where("evidence_type IS NOT NULL").groupBy("concept_id").agg(F.bool_or(strong).alias("strong"), *counts)


_PRE = "SELECT a AS source, b AS target, coalesce(confidence, 0.0) AS confidence, row_number() OVER (ORDER BY a, b, relation NULLS FIRST, confidence NULLS FIRST, reason NULLS FIRST) AS arrival FROM merge_decisions WHERE a IS NOT NULL AND b IS NOT NULL"


@query("""WITH d AS (SELECT prereq AS source, target, coalesce(confidence, 0.0) AS confidence, 0 AS arrival FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target)
SELECT least(source, target) AS a, greatest(source, target) AS b, max(confidence) AS confidence FROM d GROUP BY 1, 2""")
def prereq_dedup_arbitrated(spark: SparkSession, base: str) -> DataFrame:
    """One prerequisite for each pair of names, whatever its direction."""
    p = table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL")
    e = p.select(F.col("prereq").alias("source"), "target", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.lit(0).alias("arrival"))
    return M.arbitrate(e).select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"), "confidence")


@query(V.sql("g_mention") + ", b AS (SELECT chunk_id, concept_id, max(confidence) AS best FROM g_mention GROUP BY 1, 2) SELECT chunk_id, concept_id, round(best, 6) AS best, row_number() OVER (PARTITION BY chunk_id ORDER BY best DESC, concept_id) AS place FROM b QUALIFY place <= 10")
def best_per_chunk_top10(spark: SparkSession, base: str) -> DataFrame:
    """The ten surest concepts of every chunk."""
    b = V.mentions(spark, base, "confidence").groupBy("chunk_id", "concept_id").agg(F.max("confidence").alias("best"))
    return M.top_per_key(b, ["chunk_id"], [F.desc("best"), "concept_id"], 10).withColumn("best", F.round("best", 6))


@query(V.sql("g_prereq") + ", c AS (SELECT prereq AS source, target, max(coalesce(confidence, 0.0)) AS confidence FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target GROUP BY 1, 2) SELECT source, target, confidence, row_number() OVER (PARTITION BY target ORDER BY confidence DESC, source) AS place FROM c QUALIFY place <= 5")
def prereq_cap(spark: SparkSession, base: str) -> DataFrame:
    """The five surest prerequisites of every name."""
    p = table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target")
    c = p.groupBy(F.col("prereq").alias("source"), "target").agg(F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
    return M.top_per_key(c, ["target"], [F.desc("confidence"), "source"], 5)


@query("SELECT parent, child, count(*) AS n FROM subtype_edges WHERE parent IS NOT NULL AND child IS NOT NULL AND parent <> child GROUP BY ALL")
def subtype_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Subtype edges once, without edges to themselves."""
    return table(spark, base, "subtype_edges").where("parent <> child").groupBy("parent", "child").agg(F.count(F.lit(1)).alias("n"))


@query(V.sql("g_relation") + """SELECT source_concept_id AS source, target_concept_id AS target, relation, array_to_string(list_sort(list_distinct(list(verification_status))), '|') AS origins, round(max(confidence), 6) AS confidence, count(DISTINCT verification_reason) AS reasons FROM g_relation WHERE relation IS NOT NULL GROUP BY ALL""")
def typed_relation_merge(spark: SparkSession, base: str) -> DataFrame:
    """Origins, confidence and reasons of relations of one kind between two concepts."""
    r = V.relations(spark, base).where("relation IS NOT NULL")
    return r.groupBy(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation").agg(F.array_join(F.array_sort(F.collect_set("verification_status")), "|").alias("origins"), F.round(F.max("confidence"), 6).alias("confidence"), F.countDistinct("verification_reason").alias("reasons"))


@query(V.sql("g_relation") + "SELECT source_concept_id AS source, target_concept_id AS target, array_to_string(list_sort(list_distinct(list(relation))), '|') AS relations FROM g_relation WHERE relation IS NOT NULL GROUP BY ALL HAVING count(DISTINCT relation) > 1")
def dual_relations(spark: SparkSession, base: str) -> DataFrame:
    """Pairs with more than one kind of relation."""
    r = V.relations(spark, base).where("relation IS NOT NULL").groupBy(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"))
    return r.agg(F.array_sort(F.collect_set("relation")).alias("k")).where(F.size("k") > 1).select("source", "target", F.array_join("k", "|").alias("relations"))


@query(V.sql("g_mention") + "SELECT concept_id, count(DISTINCT chunk_id) AS chunks FROM g_mention GROUP BY concept_id")
def mention_counts(spark: SparkSession, base: str) -> DataFrame:
    """Chunks that mention each concept."""
    return V.mentions(spark, base, "concept_id", "chunk_id").select("concept_id", "chunk_id").distinct().groupBy("concept_id").agg(F.count(F.lit(1)).alias("chunks"))


@query(V.sql("g_concept") + f", a AS (SELECT concept_id, canonical_name, unnest(aliases) AS alias FROM g_concept), k AS (SELECT DISTINCT {S.name('alias')} AS alias_key, concept_id, canonical_name FROM a) SELECT alias_key, count(*) AS concepts, min(canonical_name) AS first_name, CASE WHEN length(alias_key) <= 4 THEN 'HIGH' ELSE 'MEDIUM' END AS risk FROM k WHERE alias_key <> '' GROUP BY alias_key HAVING count(*) > 1")
def alias_conflicts(spark: SparkSession, base: str) -> DataFrame:
    """Aliases that several concepts bear."""
    a = V.concepts(spark, base).select("concept_id", "canonical_name", F.explode("aliases").alias("alias"))
    k = a.select(T.normalize_name("alias").alias("alias_key"), "concept_id", "canonical_name").distinct().where("alias_key <> ''")
    g = k.groupBy("alias_key").agg(F.count(F.lit(1)).alias("concepts"), F.min("canonical_name").alias("first_name")).where("concepts > 1")
    return g.withColumn("risk", F.when(F.length("alias_key") <= 4, "HIGH").otherwise("MEDIUM"))


# Words of names that derive from others.
MARKERS = ["Daemon", "Watcher", "Tracker", "Index", "Table"]


@query(V.sql("g_concept") + ", m AS (SELECT concept_id, canonical_name, list_filter([" + ", ".join(f"'{m}'" for m in MARKERS) + "], lambda w: contains(canonical_name, w)) AS hit FROM g_concept) SELECT concept_id, array_to_string(hit, '|') AS markers FROM m WHERE len(hit) > 0")
def derived_concepts(spark: SparkSession, base: str) -> DataFrame:
    """Names with a word that marks a derived concept."""
    c = V.concepts(spark, base)
    hit = F.filter(F.array(*map(F.lit, MARKERS)), lambda w: F.contains(F.col("canonical_name"), w))
    return c.select("concept_id", hit.alias("h")).where(F.size("h") > 0).select("concept_id", F.array_join("h", "|").alias("markers"))


@query(V.sql("g_concept", "g_mention") + "SELECT c.chapter_id, count(*) AS concepts, count_if(m.concept_id IS NOT NULL) AS evidenced, round(count_if(m.concept_id IS NOT NULL) / count(*), 4) AS rate FROM g_concept c LEFT JOIN (SELECT DISTINCT concept_id FROM g_mention) m USING (concept_id) GROUP BY c.chapter_id")
def coverage_report(spark: SparkSession, base: str) -> DataFrame:
    """Concepts with evidence by chapter."""
    c = V.concepts(spark, base, "chapter_id").join(V.mentions(spark, base, "concept_id").select("concept_id").distinct().withColumn("e", F.lit(1)), "concept_id", "left")
    return c.groupBy("chapter_id").agg(F.count(F.lit(1)).alias("concepts"), F.count("e").alias("evidenced"), F.round(F.count("e") / F.count(F.lit(1)), 4).alias("rate"))


@query(V.sql("g_relation") + "SELECT relation, verification_status, count(*) AS n, round(avg(confidence), 4) AS mean FROM g_relation GROUP BY ALL")
def review_summary(spark: SparkSession, base: str) -> DataFrame:
    """Relations by kind and state of review."""
    return V.relations(spark, base).groupBy("relation", "verification_status").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 4).alias("mean"))


@query("SELECT lang, count(*) AS n, min(length(text)) AS shortest, max(length(text)) AS longest, round(avg(length(text)), 2) AS mean, round(median(length(text)), 2) AS middle FROM documents GROUP BY lang")
def chunk_length_stats(spark: SparkSession, base: str) -> DataFrame:
    """A1: lengths of texts by language."""
    n = F.length("text")
    return table(spark, base, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.round(F.avg(n), 2).alias("mean"), F.round(F.median(n), 2).alias("middle"))


@query(V.sql("g_chunk") + "SELECT chapter_id, primary_section, count(*) AS n FROM g_chunk GROUP BY ALL")
def section_distribution(spark: SparkSession, base: str) -> DataFrame:
    """Chunks by section."""
    return V.chunks(spark, base, "chapter_id", "primary_section").groupBy("chapter_id", "primary_section").agg(F.count(F.lit(1)).alias("n"))


@query(V.sql("g_concept", "g_relation") + "SELECT (SELECT count(*) FROM g_concept) AS concepts, (SELECT count(*) FROM g_relation WHERE relation = 'HAS_SUBTYPE') AS subtypes, (SELECT count(*) FROM prerequisite_edges) AS prerequisites, (SELECT count(DISTINCT book_id) FROM chapters) AS books")
def graph_stats(spark: SparkSession, base: str) -> DataFrame:
    """Four counts in one row."""
    one = V.concepts(spark, base, "concept_id").agg(F.count(F.lit(1)).alias("concepts"))
    two = V.relations(spark, base, "relation").where("relation = 'HAS_SUBTYPE'").agg(F.count(F.lit(1)).alias("subtypes"))
    three = table(spark, base, "prerequisite_edges").agg(F.count(F.lit(1)).alias("prerequisites"))
    four = table(spark, base, "chapters").agg(F.countDistinct("book_id").alias("books"))
    key = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731 - single rows meet on a constant
    return key(one).join(key(two), "_one").join(key(three), "_one").join(key(four), "_one").drop("_one")


@query(V.sql("g_chunk") + "SELECT chunk_id, lead(chunk_id) OVER (PARTITION BY chapter_id ORDER BY seq NULLS FIRST, chunk_id) AS next_chunk FROM g_chunk")
def chunk_neighbours(spark: SparkSession, base: str) -> DataFrame:
    """The chunk that follows in its chapter."""
    return V.chunks(spark, base, "chapter_id", "seq").select("chunk_id", F.lead("chunk_id").over(Window.partitionBy("chapter_id").orderBy("seq", "chunk_id")).alias("next_chunk"))


@query("SELECT 'concepts' AS tbl, concept_id AS key, count(*) AS n FROM concepts WHERE concept_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'mentions', mention_id::VARCHAR, count(*) FROM mentions GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'relations', relation_id::VARCHAR, count(*) FROM relations GROUP BY ALL HAVING count(*) > 1")
def duplicate_report(spark: SparkSession, base: str) -> DataFrame:
    """Keys that occur more than once."""
    def repeated(name: str, key: str) -> DataFrame:
        k = table(spark, base, name).where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return k.where("n > 1").select(F.lit(name).alias("tbl"), "key", "n")

    return repeated("concepts", "concept_id").union(repeated("mentions", "mention_id")).union(repeated("relations", "relation_id"))


_CONCEPT_BATCH = """o AS (SELECT concept_id, any_value(canonical_name) AS name, coalesce(arg_min(short_definition, loaded_at), '') AS definition, arg_min(status, (loaded_at, coalesce(status, ''))) AS status, arg_min(coalesce(aliases, []), (loaded_at, coalesce(aliases, [])::VARCHAR)) AS aliases FROM concepts WHERE concept_id IS NOT NULL AND loaded_at < TIMESTAMP '2024-07-01' GROUP BY concept_id),
n AS (SELECT concept_id, any_value(canonical_name) AS name, coalesce(arg_min(short_definition, loaded_at), '') AS definition, arg_min(status, (loaded_at, coalesce(status, ''))) AS status, arg_min(coalesce(aliases, []), (loaded_at, coalesce(aliases, [])::VARCHAR)) AS aliases FROM concepts WHERE concept_id IS NOT NULL AND loaded_at >= TIMESTAMP '2024-07-01' GROUP BY concept_id)"""


@query()
def upsert_concepts(spark: SparkSession, base: str) -> DataFrame:
    """M5: concepts of two periods merged: old definitions stay, aliases are appended, states overwritten."""
    rows = table(spark, base, "concepts").where("concept_id IS NOT NULL").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    key = F.struct("loaded_at", F.coalesce("status", F.lit("")), F.to_json("aliases"))
    batch = lambda df: df.groupBy("concept_id").agg(F.min_by(F.struct(F.col("canonical_name").alias("name"), F.col("short_definition").alias("definition"), "status", "aliases"), key).alias("r")).select("concept_id", "r.*")
    old, new = batch(rows.where(F.col("loaded_at") < _SPLIT)), batch(rows.where(F.col("loaded_at") >= _SPLIT))
    merged = M.merge_upsert(old, new, ["concept_id"], {"name": "keep", "definition": "nonempty_old", "aliases": "append"})
    return merged.withColumn("aliases", F.array_join("aliases", "|"))


@query(V.sql("g_mention") + f""", o AS (SELECT chunk_id, concept_id, max(confidence) AS confidence, count(*) AS n FROM g_mention WHERE loaded_at < TIMESTAMP '{_SPLIT}' GROUP BY 1, 2), n AS (SELECT chunk_id, concept_id, max(confidence) AS confidence, count(*) AS n FROM g_mention WHERE loaded_at >= TIMESTAMP '{_SPLIT}' GROUP BY 1, 2)
SELECT coalesce(o.chunk_id, n.chunk_id) AS chunk_id, coalesce(o.concept_id, n.concept_id) AS concept_id, round(greatest(o.confidence, n.confidence), 6) AS confidence, coalesce(o.n, 0) + coalesce(n.n, 0) AS n FROM o FULL JOIN n ON o.chunk_id = n.chunk_id AND o.concept_id = n.concept_id""")
def upsert_mentions(spark: SparkSession, base: str) -> DataFrame:
    """M8, M9: mentions of two periods merged: greatest confidence, counts added."""
    m = V.mentions(spark, base, "confidence", "loaded_at")
    batch = lambda df: df.groupBy("chunk_id", "concept_id").agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"))
    out = M.merge_upsert(batch(m.where(F.col("loaded_at") < _SPLIT)), batch(m.where(F.col("loaded_at") >= _SPLIT)), ["chunk_id", "concept_id"], {"confidence": "maximum", "n": "add"})
    return out.withColumn("confidence", F.round("confidence", 6))


@query(V.sql("g_relation") + f""", b AS (SELECT source_concept_id AS source, target_concept_id AS target, relation, loaded_at >= TIMESTAMP '{_SPLIT}' AS late, max(confidence) AS confidence, list_sort(list_distinct(flatten(list(coalesce(source_chunks, []))))) AS chunks FROM g_relation WHERE relation IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT source, target, relation, round(max(confidence), 6) AS confidence, array_to_string(list_sort(list_distinct(flatten(list(chunks)))), '|') AS chunks FROM b GROUP BY 1, 2, 3""")
def upsert_relations(spark: SparkSession, base: str) -> DataFrame:
    """Relations of two periods merged: chunks appended, greatest confidence."""
    r = V.relations(spark, base).where("relation IS NOT NULL").select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation", "confidence", F.coalesce("source_chunks", F.array().cast("array<string>")).alias("c"), "loaded_at")
    batch = lambda df: df.groupBy("source", "target", "relation").agg(F.max("confidence").alias("confidence"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("c")))).alias("chunks"))
    out = M.merge_upsert(batch(r.where(F.col("loaded_at") < _SPLIT)), batch(r.where(F.col("loaded_at") >= _SPLIT)), ["source", "target", "relation"], {"confidence": "maximum", "chunks": "append"})
    return out.select("source", "target", "relation", F.round("confidence", 6).alias("confidence"), F.array_join(F.array_sort("chunks"), "|").alias("chunks"))


@query("""WITH o AS (SELECT prereq AS source, target, max(confidence) AS confidence, min(reason) AS reason FROM prerequisite_edges WHERE source = 'curated' GROUP BY 1, 2), n AS (SELECT prereq AS source, target, max(confidence) AS confidence, min(reason) AS reason FROM prerequisite_edges WHERE source IS DISTINCT FROM 'curated' GROUP BY 1, 2)
SELECT coalesce(o.source, n.source) AS source, coalesce(o.target, n.target) AS target, greatest(o.confidence, n.confidence) AS confidence, coalesce(o.reason, n.reason) AS reason FROM o FULL JOIN n ON o.source IS NOT DISTINCT FROM n.source AND o.target IS NOT DISTINCT FROM n.target""".replace("AS source, target, max(confidence) AS confidence, min(reason) AS reason FROM prerequisite_edges WHERE source", "AS source, target, max(confidence) AS confidence, min(reason) AS reason FROM prerequisite_edges WHERE prerequisite_edges.source").replace("GROUP BY 1, 2", "GROUP BY prereq, target"))
def upsert_prereq(spark: SparkSession, base: str) -> DataFrame:
    """Curated prerequisites, then all others merged in: greatest confidence, first reason."""
    p = table(spark, base, "prerequisite_edges")
    batch = lambda df: df.groupBy(F.col("prereq").alias("source"), "target").agg(F.max("confidence").alias("confidence"), F.min("reason").alias("reason"))
    return M.merge_upsert(batch(p.where("source = 'curated'")), batch(p.where("source IS DISTINCT FROM 'curated'")), ["source", "target"], {"confidence": "maximum", "reason": "coalesce_old"})


@query("""SELECT chapter_id, book_id, chapter_num, CASE WHEN chapter_num % 2 = 0 THEN upper(title) ELSE title END AS title FROM chapters UNION ALL SELECT chapter_id || 'b', book_id, chapter_num, title FROM chapters WHERE chapter_num = 1""")
def upsert_structure(spark: SparkSession, base: str) -> DataFrame:
    """M1, M2, M3, M4, M7: chapters overwritten by a second batch that renames some and adds others."""
    c = table(spark, base, "chapters").select("chapter_id", "book_id", "chapter_num", "title")
    second = c.where("chapter_num % 2 = 0").withColumn("title", F.upper("title")).union(c.where("chapter_num = 1").withColumn("chapter_id", F.concat("chapter_id", F.lit("b"))))
    return M.merge_upsert(c, second, ["chapter_id"], {})


@query("SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS last_minute FROM events")
def rate_window(spark: SparkSession, base: str) -> DataFrame:
    """2.14: events of a user within the last 60 seconds."""
    e = table(spark, base, "events")
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-60_000_000, 0)
    return e.select("event_id", "user_id", F.count(F.lit(1)).over(w).alias("last_minute"))


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def checkpoint_last_wins(spark: SparkSession, base: str) -> DataFrame:
    """The last record of each key of a log."""
    e = table(spark, base, "events")
    last = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return e.groupBy("user_id", "event_type").agg(last.alias("r")).select("user_id", "event_type", "r.*")


@query(V.sql("g_chunk") + ", f AS (SELECT chunk_id, sha256('v1' || chr(10) || coalesce(text, '')) AS fingerprint, created_at FROM g_chunk), done AS (SELECT chunk_id, CASE WHEN created_at < TIMESTAMP '2024-01-01' THEN fingerprint ELSE 'stale' END AS fingerprint FROM f WHERE created_at IS NOT NULL) SELECT chunk_id FROM f WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.chunk_id = f.chunk_id AND d.fingerprint = f.fingerprint)")
def resume_pending(spark: SparkSession, base: str) -> DataFrame:
    """Chunks without a finished record of their present fingerprint."""
    f = V.chunks(spark, base).select("chunk_id", T.fingerprint(F.lit("v1"), F.col("text")).alias("fingerprint"), "created_at")
    done = f.where("created_at IS NOT NULL").select("chunk_id", F.when(F.col("created_at") < "2024-01-01", F.col("fingerprint")).otherwise("stale").alias("fingerprint"))
    return f.join(done, ["chunk_id", "fingerprint"], "left_anti").select("chunk_id")


@query(V.sql("g_concept") + f", p AS (SELECT {S.name('canonical_name', True)} AS name_key, chapter_role AS category, canonical_name, retrieval_weight AS w FROM g_concept) SELECT name_key, category, count(*) AS n, min(canonical_name) AS first_name, round(max(w), 6) AS weight FROM p GROUP BY ALL")
def schema_gap_aggregate(spark: SparkSession, base: str) -> DataFrame:
    """Proposals by normalised name and category."""
    c = V.concepts(spark, base)
    return c.groupBy(T.normalize_name("canonical_name", True).alias("name_key"), F.col("chapter_role").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.min("canonical_name").alias("first_name"), F.round(F.max("retrieval_weight"), 6).alias("weight"))


@query("""WITH p AS (SELECT p_partkey, regexp_replace(p_name, ' (process|command|service|daemon)$', '') AS family, CASE p_type WHEN 'ECONOMY' THEN 3 WHEN 'SMALL' THEN 2 ELSE 1 END AS priority FROM part) SELECT p_partkey, family, priority, max(priority) OVER (PARTITION BY family) AS family_priority FROM p""")
def queue_consolidation(spark: SparkSession, base: str) -> DataFrame:
    """The greatest priority of a family of names for all its members, aggregated before it is joined back."""
    p = table(spark, base, "part").select("p_partkey", F.regexp_replace("p_name", " (process|command|service|daemon)$", "").alias("family"), F.when(F.col("p_type") == "ECONOMY", 3).when(F.col("p_type") == "SMALL", 2).otherwise(1).alias("priority"))
    return p.join(p.groupBy("family").agg(F.max("priority").alias("family_priority")), "family").select("p_partkey", "family", "priority", "family_priority")
