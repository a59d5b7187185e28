"""Queries on joins, vectors and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import graph as G
from ..operators import retrieve as R
from ..operators import vectors as X
from ..session import table
from . import sqltext as S
from . import views as V
from .graph_queries import EXPANSION
from .registry import registry

QUERIES, ORACLES, query = registry()

_TYPES = ", ".join(f"'{t}'" for t in EXPANSION)
# Present rows with their vectors; all rows of an id carry the same one.
_VEC = """cv AS (SELECT concept_id, any_value(embedding)::DOUBLE[] AS e FROM concepts WHERE concept_id IS NOT NULL GROUP BY concept_id),
kv AS (SELECT chunk_id, any_value(embedding)::DOUBLE[] AS e FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id),
gc AS (SELECT c.*, e FROM g_concept c JOIN cv USING (concept_id) WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
gk AS (SELECT c.*, e FROM g_chunk c JOIN kv USING (chunk_id) WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0)"""
_COS = "CASE WHEN list_dot_product({0}, {0}) > 0 THEN list_cosine_similarity({0}, q) ELSE 0.0 END"


def _question(spark: SparkSession, base: str) -> list[float]:
    """The query vector: the first of the embeddings."""
    return [float(x) for x in table(spark, base, "embeddings").where("vec_id = 0").first()["embedding"]]


def _with_vectors(spark: SparkSession, base: str, name: str) -> DataFrame:
    key = "concept_id" if name == "concepts" else "chunk_id"
    v = table(spark, base, name).where(F.col(key).isNotNull()).groupBy(key).agg(F.any_value("embedding").alias("embedding"))
    return V.present(spark, base, name, "canonical_name", "short_definition", "chapter_id", "deleted_at").where("deleted_at IS NULL").join(v, key)


@query(V.sql("g_concept", "g_chunk") + f", {_VEC} SELECT chunk_id, chapter_id, round({_COS.format('e')}, 6) AS score FROM gk, q ORDER BY {_COS.format('e')} DESC, chunk_id LIMIT 6")
def vector_topk(spark: SparkSession, base: str) -> DataFrame:
    """V1: the six chunks nearest to the query vector."""
    return X.top_k(_with_vectors(spark, base, "chunks"), _question(spark, base), 6, "chunk_id").select("chunk_id", "chapter_id", F.round("score", 6).alias("score"))


@query(V.sql("g_concept", "g_chunk") + f", {_VEC}, t AS (SELECT chunk_id, chapter_id, {_COS.format('e')} AS s FROM gk, q ORDER BY s DESC, chunk_id LIMIT 200) SELECT chunk_id, round(s, 6) AS score FROM t WHERE starts_with(chapter_id, 'B01')")
def vector_topk_postfilter(spark: SparkSession, base: str) -> DataFrame:
    """V1: a filter on books after the choice of the nearest 200."""
    best = X.top_k(_with_vectors(spark, base, "chunks"), _question(spark, base), 200, "chunk_id", F.col("chapter_id").startswith("B01"), post_filter=True)
    return best.select("chunk_id", F.round("score", 6).alias("score"))


@query(V.sql("g_concept", "g_chunk") + f", {_VEC} SELECT concept_id, canonical_name, round(({_COS.format('e')} + 1) / 2, 6) AS score FROM gc, q WHERE starts_with(chapter_id, 'B01') ORDER BY ({_COS.format('e')} + 1) / 2 DESC, concept_id LIMIT 6")
def vector_topk_prefilter(spark: SparkSession, base: str) -> DataFrame:
    """V2: the six nearest concepts of a book, on the scale of an index."""
    best = X.top_k(_with_vectors(spark, base, "concepts"), _question(spark, base), 6, "concept_id", F.col("chapter_id").startswith("B01"), scale="index")
    return best.select("concept_id", "canonical_name", F.round("score", 6).alias("score"))


@query(V.sql("g_concept", "g_chunk") + f", {_VEC} SELECT canonical_name, concept_id, round({_COS.format('e')}, 6) AS score FROM gc, q WHERE {_COS.format('e')} >= 0.1")
def seeds_only(spark: SparkSession, base: str) -> DataFrame:
    """All concepts of some similarity, best first."""
    s = X.scored(_with_vectors(spark, base, "concepts"), _question(spark, base)).where("score >= 0.1")
    return s.select("canonical_name", "concept_id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "canonical_name")


@query("WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS score FROM embeddings, q")
def semantic_scores(spark: SparkSession, base: str) -> DataFrame:
    """V4, V5: the score of every vector against the query vector."""
    return X.scored(table(spark, base, "embeddings"), _question(spark, base)).select("vec_id", F.round("score", 6).alias("score"))


@query("SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3")
def similar_pairs_cross_book(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of different labels of some similarity, by block products."""
    return X.block_pairs(table(spark, base, "embeddings"), "vec_id", "label", 0.3).withColumn("score", F.round("score", 6))


@query()
def embed_texts(spark: SparkSession, base: str) -> DataFrame:
    """Concepts embedded by name and definition."""
    c = V.concepts(spark, base).select("concept_id", F.concat_ws(". ", "canonical_name", "short_definition").alias("t"))
    return X.embed_column(c, F.substring("t", 1, 8000), X.HashEmbedder(64)).select("concept_id", "embedding", "model_id")


@query("SELECT concept_id FROM (SELECT concept_id, max(CASE WHEN len(embedding) = 64 THEN 1 ELSE 0 END) AS ok FROM concepts WHERE concept_id IS NOT NULL GROUP BY concept_id) WHERE ok = 0")
def missing_embeddings(spark: SparkSession, base: str) -> DataFrame:
    """Concepts without a vector of the right length."""
    c = table(spark, base, "concepts").where("concept_id IS NOT NULL").groupBy("concept_id").agg(F.max(F.when(F.size("embedding") == 64, 1).otherwise(0)).alias("ok"))
    return c.where("ok = 0").select("concept_id")


@query("SELECT concept_id, max(len(embedding)) AS dim, max(CASE WHEN len(embedding) = 64 THEN 'given' ELSE 'hash-trigram-64' END) AS model_id FROM (SELECT concept_id, CASE WHEN len(embedding) = 64 THEN embedding ELSE list_transform(range(64), lambda x: 0.0) END AS embedding, embedding AS raw FROM concepts WHERE concept_id IS NOT NULL) GROUP BY concept_id".replace("max(CASE WHEN len(embedding) = 64 THEN 'given' ELSE 'hash-trigram-64' END)", "min(CASE WHEN len(raw) = 64 THEN 'given' ELSE 'hash-trigram-64' END)"))
def embedding_writeback(spark: SparkSession, base: str) -> DataFrame:
    """Vectors made for concepts that have none, written back by id."""
    c = table(spark, base, "concepts").where("concept_id IS NOT NULL").groupBy("concept_id").agg(F.any_value("canonical_name").alias("name"), F.any_value("embedding").alias("embedding"))
    c = c.withColumn("embedding", F.when(F.size("embedding") == 64, F.col("embedding"))).withColumn("model_id", F.when(F.col("embedding").isNotNull(), "given"))
    fresh = X.embed_column(c.where("embedding IS NULL").select("concept_id", "name"), F.col("name"), X.HashEmbedder(64))
    return X.write_back(c, fresh, "concept_id").select("concept_id", F.size("embedding").alias("dim"), "model_id")


@query(V.sql("g_concept", "g_chunk", "g_mention") + f", {_VEC}, s AS (SELECT concept_id FROM gc, q ORDER BY {_COS.format('e')} DESC, concept_id LIMIT 50) SELECT chunk_id, count(DISTINCT concept_id) AS n_concepts, round(0.3 + 0.05 * count(DISTINCT concept_id), 6)::DOUBLE AS score FROM g_mention WHERE concept_id IN (SELECT concept_id FROM s) GROUP BY chunk_id ORDER BY n_concepts DESC, chunk_id LIMIT 12")
def concept_chunks_topn(spark: SparkSession, base: str) -> DataFrame:
    """Chunks that mention most of the 50 nearest concepts."""
    s = X.top_k(_with_vectors(spark, base, "concepts"), _question(spark, base), 50, "concept_id").select("concept_id")
    none = V.chunks(spark, base).limit(0).select("chunk_id")
    return R.evidence_chunks(V.mentions(spark, base, "concept_id"), s, none, 12).withColumn("score", F.round("score", 6))


_HYBRID = V.sql("g_concept", "g_chunk", "g_mention", "g_relation") + f""", {_VEC}, hits AS (SELECT chunk_id, {_COS.format('e')} AS score FROM gk, q ORDER BY score DESC, chunk_id LIMIT 5),
direct AS (SELECT concept_id, {_COS.format('e')} AS score FROM gc, q ORDER BY score DESC, concept_id LIMIT 6),
said AS (SELECT concept_id, max(score) * 0.7::DOUBLE AS score FROM g_mention JOIN hits USING (chunk_id) GROUP BY concept_id),
seeds AS (SELECT concept_id, score, 0 AS o FROM direct UNION ALL SELECT concept_id, score, 1 FROM said),
e AS (SELECT source_concept_id AS s, target_concept_id AS t FROM g_relation WHERE relation IN ({_TYPES}) AND source_concept_id <> target_concept_id UNION SELECT target_concept_id, source_concept_id FROM g_relation WHERE relation IN ({_TYPES}) AND source_concept_id <> target_concept_id),
h1 AS (SELECT DISTINCT t AS node FROM e WHERE s IN (SELECT concept_id FROM seeds) AND t NOT IN (SELECT concept_id FROM seeds)),
h2 AS (SELECT DISTINCT t AS node FROM e WHERE s IN (SELECT node FROM h1) AND t NOT IN (SELECT concept_id FROM seeds) AND t NOT IN (SELECT node FROM h1)),
near AS (SELECT node, d FROM (SELECT node, 1 AS d FROM h1 UNION ALL SELECT node, 2 FROM h2) ORDER BY d, node LIMIT 40),
allc AS (SELECT * FROM seeds UNION ALL SELECT node, 0.5::DOUBLE / d, 2 FROM near),
best AS (SELECT concept_id, arg_min(score, (o, -score)) AS score, min(o) AS o FROM allc GROUP BY concept_id)"""


@query(_HYBRID + " SELECT concept_id, round(score, 6) AS score, ['vector', 'chunk_mention', 'graph_expand'][o + 1] AS origin FROM best")
def hybrid_retrieve(spark: SparkSession, base: str) -> DataFrame:
    """Concepts for the query vector by search, mention and expansion."""
    found = _hybrid(spark, base)["concepts"]
    return found.select("concept_id", F.round("score", 6).alias("score"), "origin").orderBy(F.desc("score"), "concept_id")


@query(_HYBRID + """, ev AS (SELECT chunk_id, count(DISTINCT concept_id) AS n FROM g_mention WHERE concept_id IN (SELECT concept_id FROM best) AND chunk_id NOT IN (SELECT chunk_id FROM hits) GROUP BY chunk_id ORDER BY n DESC, chunk_id LIMIT 12)
SELECT chunk_id, round(score, 6) AS score, 'vector' AS origin FROM hits UNION ALL SELECT chunk_id, round(0.3::DOUBLE + 0.05::DOUBLE * n, 6), 'graph_expand' FROM ev""")
def hybrid_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Chunks for the query vector by search and by the concepts found."""
    return _hybrid(spark, base)["chunks"].select("chunk_id", F.round("score", 6).alias("score"), "origin")


def _hybrid(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return R.hybrid(_question(spark, base), _with_vectors(spark, base, "concepts"), _with_vectors(spark, base, "chunks"), V.mentions(spark, base, "concept_id"), V.relations(spark, base, "relation"), EXPANSION)


_SOME = "(SELECT k AS concept_id, array_to_string(list(v ORDER BY v), '|') AS vs FROM (SELECT DISTINCT {0} AS k, {1} AS v FROM {2} QUALIFY row_number() OVER (PARTITION BY k ORDER BY v) <= 3) GROUP BY k)"


def _some(key: str, value: str, source: str) -> str:
    return f"(SELECT k AS concept_id, array_to_string(list(v ORDER BY v), '|') AS vs FROM (SELECT k, v FROM (SELECT DISTINCT {key} AS k, {value} AS v FROM {source}) QUALIFY row_number() OVER (PARTITION BY k ORDER BY v) <= 3) GROUP BY k)"


@query(V.sql("g_concept", "g_mention", "g_relation") + ", e AS (SELECT source_concept_id AS source, target_concept_id AS target, relation FROM g_relation)" + f""" SELECT c.concept_id, coalesce(a.vs, '') AS chunks, coalesce(b.vs, '') AS prerequisites, coalesce(d.vs, '') AS leads_to, coalesce(f.vs, '') AS subtypes, coalesce(g.vs, '') AS parents FROM g_concept c
LEFT JOIN {_some('concept_id', 'chunk_id', 'g_mention')} a USING (concept_id) LEFT JOIN {_some('target', 'source', "(SELECT * FROM e WHERE relation IN ('USES', 'PART_OF'))")} b USING (concept_id)
LEFT JOIN {_some('source', 'target', "(SELECT * FROM e WHERE relation IN ('USES', 'PART_OF'))")} d USING (concept_id) LEFT JOIN {_some('source', 'target', "(SELECT * FROM e WHERE relation = 'HAS_SUBTYPE')")} f USING (concept_id)
LEFT JOIN {_some('target', 'source', "(SELECT * FROM e WHERE relation = 'HAS_SUBTYPE')")} g USING (concept_id)""")
def concept_context(spark: SparkSession, base: str) -> DataFrame:
    """What surrounds every concept."""
    e = V.relations(spark, base, "relation").select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation")
    return R.context(V.concepts(spark, base, "concept_id"), V.mentions(spark, base, "concept_id"), e)


def _first_sql(name: str, key: str, value: str, source: str) -> str:
    """The first three values of each seed, in order, as one text; source ends in a condition."""
    return f"{name}_v AS (SELECT DISTINCT {key} AS concept_id, {value} AS v FROM {source} AND {key} IN (SELECT concept_id FROM s)), {name} AS (SELECT concept_id, string_agg(v, '|' ORDER BY v) AS {name} FROM (SELECT * FROM {name}_v QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY v) <= 3) GROUP BY 1)"


def _walk_sql(name: str, here: str, there: str) -> str:
    return f"{name}_w(start, node, d) AS (SELECT s.name, p.{there}, 1 FROM s JOIN g_prereq p ON p.{here} = s.name UNION SELECT w.start, p.{there}, d + 1 FROM {name}_w w JOIN g_prereq p ON p.{here} = w.node WHERE d < 3), {name} AS (SELECT start AS name, string_agg(node || ':' || d, '|' ORDER BY d, node) AS {name} FROM {name}_w GROUP BY 1)"


@query(V.sql("g_concept", "g_chunk", "g_mention", "g_relation", "g_prereq", recursive=True) + f""", {_VEC}, s AS (SELECT gc.concept_id, gc.canonical_name, n.name, {_COS.format('e')} AS score FROM gc JOIN g_concept n USING (concept_id), q ORDER BY score DESC, gc.canonical_name LIMIT 5),
{_first_sql('chunks', 'concept_id', 'chunk_id', 'g_mention WHERE true')}, {_first_sql('prerequisites', 'target_concept_id', 'source_concept_id', "g_relation WHERE relation IN ('USES', 'PART_OF')")}, {_first_sql('leads_to', 'source_concept_id', 'target_concept_id', "g_relation WHERE relation IN ('USES', 'PART_OF')")},
{_first_sql('subtypes', 'source_concept_id', 'target_concept_id', "g_relation WHERE relation = 'HAS_SUBTYPE'")}, {_first_sql('parents', 'target_concept_id', 'source_concept_id', "g_relation WHERE relation = 'HAS_SUBTYPE'")}, {_walk_sql('upstream', 'target', 'source')}, {_walk_sql('downstream', 'source', 'target')}
SELECT canonical_name, round(score, 6) AS score, coalesce(chunks, '') AS chunks, coalesce(prerequisites, '') AS prerequisites, coalesce(leads_to, '') AS leads_to, coalesce(subtypes, '') AS subtypes, coalesce(parents, '') AS parents, coalesce(upstream, '') AS upstream, coalesce(downstream, '') AS downstream
FROM s LEFT JOIN chunks USING (concept_id) LEFT JOIN prerequisites USING (concept_id) LEFT JOIN leads_to USING (concept_id) LEFT JOIN subtypes USING (concept_id) LEFT JOIN parents USING (concept_id) LEFT JOIN upstream USING (name) LEFT JOIN downstream USING (name)""")
def seed_retrieve(spark: SparkSession, base: str) -> DataFrame:
    """The five nearest concepts, what surrounds each (J13), and the prerequisites above (G2) and below (G3) it to three levels."""
    from ..session import cut

    near = X.scored(_with_vectors(spark, base, "concepts"), _question(spark, base)).orderBy(F.desc("score"), "canonical_name").limit(5).select("concept_id", "canonical_name", "score")
    s = cut(near.join(V.concepts(spark, base, "name"), "concept_id"))
    own = F.broadcast(s.select("concept_id"))  # five rows
    e = V.relations(spark, base, "relation").select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation")
    ends = e.join(own.withColumnRenamed("concept_id", "source"), "source", "left_semi").union(e.join(own.withColumnRenamed("concept_id", "target"), "target", "left_semi").select("source", "target", "relation"))
    around = R.context(s.select("concept_id"), V.mentions(spark, base, "concept_id").join(own, "concept_id", "left_semi"), ends)
    pre, starts = V.prerequisites(spark, base), s.select(F.col("name").alias("node"))
    reached = lambda up, name: G.walks(pre, starts, 3, up).groupBy(F.col("start").alias("name")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("distance", "node"))), lambda x: F.concat(x["node"], F.lit(":"), x["distance"].cast("string"))), "|").alias(name))
    out = s.join(around, "concept_id", "left").join(reached(True, "upstream"), "name", "left").join(reached(False, "downstream"), "name", "left")
    return out.select("canonical_name", F.round("score", 6).alias("score"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("chunks", "prerequisites", "leads_to", "subtypes", "parents", "upstream", "downstream")))


@query(V.sql("g_concept", "g_chunk", "g_mention") + f""", {_VEC}, s AS (SELECT concept_id, canonical_name, short_definition, {_COS.format('e')} AS score FROM gc, q ORDER BY score DESC, concept_id LIMIT 8)
SELECT string_agg('- ' || canonical_name || ': ' || left(coalesce(short_definition, ''), 200), chr(10) ORDER BY score DESC, concept_id) AS prompt FROM s""")
def qa_context(spark: SparkSession, base: str) -> DataFrame:
    """The nearest eight concepts as the text of a prompt."""
    s = X.top_k(_with_vectors(spark, base, "concepts"), _question(spark, base), 8, "concept_id")
    line = F.concat(F.lit("- "), "canonical_name", F.lit(": "), F.substring(F.coalesce("short_definition", F.lit("")), 1, 200))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "concept_id", line.alias("line"))))
    return s.agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("prompt"))


@query(V.sql("g_concept", "g_chunk", "g_mention") + f""", {_VEC}, s AS (SELECT concept_id, {_COS.format('e')} AS score FROM gc, q ORDER BY score DESC, concept_id LIMIT 5), m AS (SELECT DISTINCT concept_id, chunk_id FROM g_mention WHERE concept_id IN (SELECT concept_id FROM s)),
r AS (SELECT m.concept_id, m.chunk_id, {_COS.format('gk.e')} AS score, row_number() OVER (PARTITION BY m.concept_id ORDER BY {_COS.format('gk.e')} DESC, m.chunk_id) AS n FROM m JOIN gk USING (chunk_id), q)
SELECT chunk_id, round(max(score), 6) AS score FROM r WHERE n <= 3 GROUP BY chunk_id ORDER BY max(score) DESC, chunk_id LIMIT 5""")
def tutoring_policy(spark: SparkSession, base: str) -> DataFrame:
    """Five seeds, the best three chunks of each, the best five of these."""
    q = _question(spark, base)
    s = X.top_k(_with_vectors(spark, base, "concepts"), q, 5, "concept_id").select("concept_id")
    m = V.mentions(spark, base).join(F.broadcast(s), "concept_id").select("concept_id", "chunk_id").distinct()
    r = m.join(X.scored(_with_vectors(spark, base, "chunks"), q).select("chunk_id", "score"), "chunk_id")
    place = F.row_number().over(Window.partitionBy("concept_id").orderBy(F.desc("score"), "chunk_id"))
    best = r.withColumn("n", place).where("n <= 3").groupBy("chunk_id").agg(F.max("score").alias("s")).orderBy(F.desc("s"), "chunk_id").limit(5)
    return best.select("chunk_id", F.round("s", 6).alias("score"))


@query(V.sql("g_chunk", "g_mention") + "SELECT chunk_id, count(DISTINCT concept_id) AS concepts, min(concept_id) AS first_concept FROM g_chunk JOIN g_mention USING (chunk_id) GROUP BY chunk_id")
def chunk_mentions(spark: SparkSession, base: str) -> DataFrame:
    """Concepts of every chunk."""
    m = V.mentions(spark, base, "concept_id").join(V.chunks(spark, base, "chunk_id").select("chunk_id"), "chunk_id")
    return m.groupBy("chunk_id").agg(F.countDistinct("concept_id").alias("concepts"), F.min("concept_id").alias("first_concept"))


@query(V.sql("g_concept", "g_chunk", "g_mention") + """, k AS (SELECT concept_id, min(primary_section) AS first_section, array_to_string(list_sort(list_distinct(list(chapter_id))), '|') AS chapters FROM g_mention JOIN g_chunk USING (chunk_id) GROUP BY concept_id) SELECT c.concept_id, c.short_definition, coalesce(len(c.local_kp_ids), 0) AS kps, k.first_section, coalesce(k.chapters, '') AS chapters FROM g_concept c LEFT JOIN k USING (concept_id)""")
def concept_detail(spark: SparkSession, base: str) -> DataFrame:
    """Details of every concept with its chapters and first section."""
    k = V.mentions(spark, base, "concept_id").join(V.chunks(spark, base, "chunk_id", "chapter_id", "primary_section").select("chunk_id", "chapter_id", "primary_section"), "chunk_id")
    k = k.groupBy("concept_id").agg(F.min("primary_section").alias("first_section"), F.array_join(F.array_sort(F.collect_set("chapter_id")), "|").alias("chapters"))
    c = V.concepts(spark, base).select("concept_id", "short_definition", F.greatest(F.size("local_kp_ids"), F.lit(0)).alias("kps"))
    return c.join(k, "concept_id", "left").withColumn("chapters", F.coalesce("chapters", F.lit("")))


@query(V.sql("g_chunk", "g_mention") + """, l AS (SELECT DISTINCT m.concept_id, k.chunk_id, k.page_start, coalesce(h.title, k.chapter_id) AS chapter, h.book_id FROM g_mention m JOIN g_chunk k USING (chunk_id) LEFT JOIN chapters h USING (chapter_id))
SELECT concept_id, book_id, chunk_id, chapter, page_start FROM l QUALIFY row_number() OVER (PARTITION BY concept_id, book_id ORDER BY page_start NULLS FIRST, chunk_id) <= 5""")
def concept_locations(spark: SparkSession, base: str) -> DataFrame:
    """Places of every concept, five at most in a book."""
    k = V.chunks(spark, base, "chunk_id", "chapter_id", "page_start").select("chunk_id", "chapter_id", "page_start")
    h = table(spark, base, "chapters").select("chapter_id", "title", "book_id")
    loc = V.mentions(spark, base, "concept_id", "chunk_id").select("concept_id", "chunk_id").distinct().join(k, "chunk_id").join(F.broadcast(h), "chapter_id", "left")
    loc = loc.select("concept_id", "book_id", "chunk_id", F.coalesce("title", "chapter_id").alias("chapter"), "page_start")
    place = F.row_number().over(Window.partitionBy("concept_id", "book_id").orderBy("page_start", "chunk_id"))
    return loc.withColumn("n", place).where("n <= 5").drop("n")


@query(V.sql("g_concept") + f", k AS (SELECT DISTINCT concept_id, {S.name('name')} AS key FROM g_concept), d AS (SELECT DISTINCT unnest([a, b]) AS term FROM merge_decisions) SELECT term, concept_id FROM d JOIN k ON {S.name('term')} = k.key WHERE k.key <> ''")
def name_index_join(spark: SparkSession, base: str) -> DataFrame:
    """Concepts that the names in merge decisions stand for."""
    k = V.concepts(spark, base).select("concept_id", F.explode(F.array_distinct(F.array(T.normalize_name("name")))).alias("key")).where("key <> ''")
    d = table(spark, base, "merge_decisions").select(F.explode(F.array("a", "b")).alias("term")).where("term IS NOT NULL").distinct()
    return d.withColumn("key", T.normalize_name("term")).join(k, "key").select("term", "concept_id")


@query(V.sql("g_concept", "g_chunk", "g_mention") + "SELECT chapter_id, count(*) AS concepts FROM (SELECT chapter_id, concept_id FROM g_concept WHERE chapter_id IS NOT NULL UNION SELECT k.chapter_id, m.concept_id FROM g_mention m JOIN g_chunk k USING (chunk_id) WHERE k.chapter_id IS NOT NULL) GROUP BY chapter_id")
def chapter_index(spark: SparkSession, base: str) -> DataFrame:
    """Concepts of a chapter, its own and mentioned ones."""
    own = V.concepts(spark, base).where("chapter_id IS NOT NULL").select("chapter_id", "concept_id")
    said = V.mentions(spark, base, "concept_id").join(V.chunks(spark, base, "chapter_id").where("chapter_id IS NOT NULL").select("chunk_id", "chapter_id"), "chunk_id").select("chapter_id", "concept_id")
    return own.union(said).distinct().groupBy("chapter_id").agg(F.count(F.lit(1)).alias("concepts"))


@query("WITH w AS (SELECT DISTINCT chapter_id AS asked FROM documents WHERE chapter_id IS NOT NULL UNION SELECT DISTINCT split_part(chapter_id, '_', 2) FROM chapters WHERE chapter_num <= 2) SELECT asked, CASE WHEN max(e.chapter_id) IS NOT NULL THEN max(e.chapter_id) WHEN count(DISTINCT s.chapter_id) = 1 THEN max(s.chapter_id) END AS chapter_id, count(DISTINCT s.chapter_id) AS candidates FROM w LEFT JOIN chapters e ON e.chapter_id = asked LEFT JOIN chapters s ON ends_with(s.chapter_id, '_' || asked) GROUP BY asked")
def chapter_resolve(spark: SparkSession, base: str) -> DataFrame:
    """Chapters by exact id, else by a suffix that only one has."""
    h = table(spark, base, "chapters")
    asked = table(spark, base, "documents").where("chapter_id IS NOT NULL").select(F.col("chapter_id").alias("asked")).union(h.where("chapter_num <= 2").select(F.element_at(F.split("chapter_id", "_"), 2))).distinct()
    ids = h.select("chapter_id")
    exact = ids.select(F.col("chapter_id").alias("asked"), F.col("chapter_id").alias("exact"))
    parts = F.split("chapter_id", "_")
    suffixes = ids.select("chapter_id", F.explode(F.transform(F.sequence(F.lit(2), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "_"))).alias("asked"))
    by_end = suffixes.groupBy("asked").agg(F.countDistinct("chapter_id").alias("candidates"), F.max("chapter_id").alias("only"))
    out = asked.join(F.broadcast(exact), "asked", "left").join(F.broadcast(by_end), "asked", "left")
    return out.select("asked", F.coalesce("exact", F.when(F.col("candidates") == 1, F.col("only"))).alias("chapter_id"), F.coalesce("candidates", F.lit(0)).alias("candidates"))


@query(V.sql("g_concept", "g_relation") + "SELECT relation_id, s.concept_id IS NOT NULL AS source_known, t.concept_id IS NOT NULL AS target_known FROM g_relation LEFT JOIN g_concept s ON s.concept_id = source_concept_id LEFT JOIN g_concept t ON t.concept_id = target_concept_id")
def endpoint_filter(spark: SparkSession, base: str) -> DataFrame:
    """Which ends of every relation are known concepts."""
    c = V.concepts(spark, base, "concept_id").select("concept_id")
    side = lambda x: c.select(F.col("concept_id").alias(f"{x}_concept_id"), F.lit(True).alias(f"{x}_known"))
    r = V.relations(spark, base).join(side("source"), "source_concept_id", "left").join(side("target"), "target_concept_id", "left")
    return r.select("relation_id", F.coalesce("source_known", F.lit(False)).alias("source_known"), F.coalesce("target_known", F.lit(False)).alias("target_known"))


@query(V.sql("g_concept", "g_mention") + "SELECT mention_id, CASE WHEN c.concept_id IS NULL THEN 'audit' ELSE 'formal' END AS part FROM g_mention LEFT JOIN (SELECT concept_id FROM g_concept WHERE upper(trim(status)) = 'APPROVED') c USING (concept_id)")
def formal_split(spark: SparkSession, base: str) -> DataFrame:
    """Mentions of approved concepts and all others."""
    m, ok = V.mentions(spark, base, "concept_id"), V.concepts(spark, base, "status").where("upper(trim(status)) = 'APPROVED'").select("concept_id")
    return m.join(ok, "concept_id", "left_semi").select("mention_id", F.lit("formal").alias("part")).union(m.join(ok, "concept_id", "left_anti").select("mention_id", F.lit("audit")))


@query(V.sql("g_concept", "g_mention") + "SELECT concept_id, canonical_name FROM g_concept WHERE concept_id NOT IN (SELECT concept_id FROM g_mention)")
def missing_prereq_anti(spark: SparkSession, base: str) -> DataFrame:
    """Concepts nobody mentions."""
    return V.concepts(spark, base).join(V.mentions(spark, base, "concept_id"), "concept_id", "left_anti").select("concept_id", "canonical_name")


_BEST10 = "b AS (SELECT chunk_id, concept_id FROM (SELECT chunk_id, concept_id, max(confidence) AS best FROM g_mention GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY best DESC, concept_id) <= 10)"


def _best10(spark: SparkSession, base: str) -> DataFrame:
    from ..operators.merge import top_per_key

    b = V.mentions(spark, base, "confidence").groupBy("chunk_id", "concept_id").agg(F.max("confidence").alias("best"))
    return top_per_key(b, ["chunk_id"], [F.desc("best"), "concept_id"], 10).select("chunk_id", "concept_id")


@query(V.sql("g_mention") + f", {_BEST10} SELECT x.concept_id AS a, y.concept_id AS b, count(*) AS shared FROM b x JOIN b y ON x.chunk_id = y.chunk_id AND x.concept_id < y.concept_id GROUP BY 1, 2")
def shared_chunk_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Concepts in one chunk, among the ten surest of each: at most 45 pairs a chunk."""
    t = _best10(spark, base).groupBy("chunk_id").agg(F.array_sort(F.collect_list("concept_id")).alias("c"))
    pairs = t.select(F.explode(F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.lit(10)), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
    return pairs.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("shared"))


@query(V.sql("g_mention", "g_relation") + f""", {_BEST10}, w AS (SELECT x.concept_id AS a, y.concept_id AS b, 1 AS s FROM b x JOIN b y ON x.chunk_id = y.chunk_id AND x.concept_id < y.concept_id UNION ALL SELECT least(source_concept_id, target_concept_id), greatest(source_concept_id, target_concept_id), 3 FROM g_relation WHERE source_concept_id <> target_concept_id),
p AS (SELECT a, b, sum(s) AS score FROM w GROUP BY 1, 2), ends AS (SELECT a AS me, a, b, score FROM p UNION ALL SELECT b, a, b, score FROM p)
SELECT DISTINCT a, b, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY me ORDER BY score DESC, a, b) AS n FROM ends) WHERE n <= 5""")
def prereq_candidates(spark: SparkSession, base: str) -> DataFrame:
    """Pairs among the five strongest of either end, by relations and shared chunks."""
    shared = shared_chunk_pairs(spark, base).select("a", "b", F.col("shared").alias("s"))
    r = V.relations(spark, base, "relation").where("source_concept_id <> target_concept_id")
    linked = r.groupBy(F.least("source_concept_id", "target_concept_id").alias("a"), F.greatest("source_concept_id", "target_concept_id").alias("b")).agg((F.count(F.lit(1)) * 3).alias("s"))
    p = shared.union(linked).groupBy("a", "b").agg(F.sum("s").alias("score"))
    ends = p.select("a", "b", "score", F.explode(F.array("a", "b")).alias("me"))
    place = F.row_number().over(Window.partitionBy("me").orderBy(F.desc("score"), "a", "b"))
    return ends.withColumn("n", place).where("n <= 5").select("a", "b", "score").distinct()


@query(V.sql("g_mention") + f", k AS (SELECT concept_id, chunk_id, {S.normal_text('quote')} AS q, min(mention_id) AS first FROM g_mention GROUP BY ALL) SELECT concept_id, chunk_id, md5(q) AS quote_key FROM k QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY first) <= 3")
def evidence_context(spark: SparkSession, base: str) -> DataFrame:
    """The first three different quotes of every concept."""
    k = V.mentions(spark, base).groupBy("concept_id", "chunk_id", T.normalize_text("quote").alias("q")).agg(F.min("mention_id").alias("first"))
    place = F.row_number().over(Window.partitionBy("concept_id").orderBy("first"))
    return k.withColumn("n", place).where("n <= 3").select("concept_id", "chunk_id", F.md5("q").alias("quote_key"))


@query("SELECT 'chapter' AS kind, book_id AS source, chapter_id AS target FROM chapters UNION ALL SELECT 'subtype', parent, child FROM subtype_edges UNION ALL SELECT 'prerequisite', prereq, target FROM prerequisite_edges")
def graph_export(spark: SparkSession, base: str) -> DataFrame:
    """All edges of the graph in one table."""
    a = table(spark, base, "chapters").select(F.lit("chapter").alias("kind"), F.col("book_id").alias("source"), F.col("chapter_id").alias("target"))
    b = table(spark, base, "subtype_edges").select(F.lit("subtype").alias("kind"), F.col("parent").alias("source"), F.col("child").alias("target"))
    c = table(spark, base, "prerequisite_edges").select(F.lit("prerequisite").alias("kind"), F.col("prereq").alias("source"), "target")
    return a.unionByName(b).unionByName(c)


@query("SELECT book_id, arg_min(title, (pri, title)) AS title FROM (SELECT book_id, book_title AS title, 1 AS pri FROM chapters UNION ALL SELECT book_id, upper(book_title), 0 FROM chapters WHERE chapter_num = 3) GROUP BY book_id")
def book_index(spark: SparkSession, base: str) -> DataFrame:
    """Titles of books from two sources, of which the first has precedence."""
    h = table(spark, base, "chapters")
    both = h.select("book_id", F.col("book_title").alias("title"), F.lit(1).alias("pri")).union(h.where("chapter_num = 3").select("book_id", F.upper("book_title"), F.lit(0)))
    return both.groupBy("book_id").agg(F.min_by("title", F.struct("pri", "title")).alias("title"))
