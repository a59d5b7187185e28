"""Queries on graph operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graph as G
from ..session import table
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()

# Types along which a retrieval expands.
EXPANSION = ["HAS_SUBTYPE", "PART_OF", "USES", "CAUSES", "MANAGES"]
_TYPES = ", ".join(f"'{t}'" for t in EXPANSION)


def _edges(spark: SparkSession, base: str) -> DataFrame:
    r = V.relations(spark, base, "relation").where("relation IS NOT NULL")
    return r.select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"), "relation", "confidence", "relation_id")


def _seeds(spark: SparkSession, base: str) -> DataFrame:
    """The five concepts that are mentioned most."""
    return V.mentions(spark, base, "concept_id").groupBy(F.col("concept_id").alias("node")).count().orderBy(F.desc("count"), "node").limit(5).select("node")


_REL = "e AS (SELECT source_concept_id AS source, target_concept_id AS target, relation, confidence, relation_id FROM g_relation WHERE relation IS NOT NULL)"
_SEED = "seeds AS (SELECT concept_id AS node FROM g_mention GROUP BY concept_id ORDER BY count(*) DESC, concept_id LIMIT 5)"
_NEAR = f"near AS (SELECT source, target FROM e WHERE relation IN ({_TYPES}) AND source <> target UNION SELECT target, source FROM e WHERE relation IN ({_TYPES}) AND source <> target)"


@query(V.sql("g_relation", "g_mention") + f", {_REL}, {_SEED}, {_NEAR}" + """,
h1 AS (SELECT DISTINCT target AS node FROM near JOIN seeds ON source = node EXCEPT SELECT node FROM seeds),
h2 AS (SELECT DISTINCT target AS node FROM near JOIN h1 ON source = node EXCEPT (SELECT node FROM seeds UNION SELECT node FROM h1))
SELECT node, 1 AS dist, 0.5::DOUBLE AS score FROM h1 UNION ALL SELECT node, 2, 0.25::DOUBLE FROM h2""")
def expand_hops(spark: SparkSession, base: str) -> DataFrame:
    """G1: concepts within two hops of the most mentioned ones."""
    return G.expand(_edges(spark, base).where(F.col("relation").isin(EXPANSION)), _seeds(spark, base), 2)


_LEVELS = """, l0 AS (SELECT DISTINCT {0} AS start, {0} AS node FROM g_prereq), l1 AS (SELECT DISTINCT start, {1} AS node FROM l0 JOIN g_prereq ON {0} = node),
l2 AS (SELECT DISTINCT start, {1} AS node FROM l1 JOIN g_prereq ON {0} = node)
SELECT start, node, 1 AS distance FROM l1 UNION ALL SELECT start, node, 2 FROM l2"""


@query(V.sql("g_prereq") + _LEVELS.format("target", "source"))
def prereq_upstream(spark: SparkSession, base: str) -> DataFrame:
    """What every target builds on, two levels deep."""
    p = V.prerequisites(spark, base)
    return G.walks(p, p.select(F.col("target").alias("node")), 2, upstream=True)


@query(V.sql("g_prereq") + _LEVELS.format("source", "target"))
def prereq_downstream(spark: SparkSession, base: str) -> DataFrame:
    """What builds on every source, two levels deep."""
    p = V.prerequisites(spark, base)
    return G.walks(p, p.select(F.col("source").alias("node")), 2)


_WEIGHTED = "w AS (SELECT prereq AS source, target, max(" + S.clamp("confidence") + ") AS confidence FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target GROUP BY 1, 2)"


def _weighted(spark: SparkSession, base: str) -> DataFrame:
    from ..functions.text import clamp

    p = table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target")
    return p.groupBy(F.col("prereq").alias("source"), "target").agg(F.max(clamp(F.col("confidence"))).alias("confidence"))


@query("WITH " + _WEIGHTED + """, c1 AS (SELECT a.target AS start, [a.source, a.target] AS chain, a.confidence FROM w a),
c2 AS (SELECT b.target AS start, [a.source, b.source, b.target] AS chain, b.confidence * a.confidence AS confidence FROM w a JOIN w b ON a.target = b.source WHERE NOT (a.source = b.source AND a.target = b.target)),
c3 AS (SELECT c.target AS start, [a.source, b.source, c.source, c.target] AS chain, c.confidence * b.confidence * a.confidence AS confidence FROM w a JOIN w b ON a.target = b.source JOIN w c ON b.target = c.source
  WHERE NOT (a.source = c.source AND a.target = c.target))
SELECT start, array_to_string(chain, ' > ') AS chain, depth, round(confidence, 6) AS confidence FROM (SELECT *, 1 AS depth FROM c1 UNION ALL SELECT *, 2 FROM c2 UNION ALL SELECT *, 3 FROM c3)""")
def prereq_chains(spark: SparkSession, base: str) -> DataFrame:
    """Chains of up to three prerequisites to every target, with the product of their confidences."""
    w = _weighted(spark, base)
    c = G.chains(w, w.select(F.col("target").alias("node")).distinct(), 3)
    return c.select("start", F.array_join("chain", " > ").alias("chain"), "depth", F.round("confidence", 6).alias("confidence"))


@query(V.sql("g_relation", "g_mention") + f", {_REL}, {_SEED}, {_NEAR}" + """, p AS (SELECT a.node AS a, b.node AS b FROM seeds a JOIN seeds b ON a.node < b.node),
r1 AS (SELECT a, b, 1 AS hops, a || ' - ' || b AS path FROM p JOIN near ON source = a AND target = b),
r2 AS (SELECT a, b, 2 AS hops, min(a || ' - ' || x.target || ' - ' || b) AS path FROM p JOIN near x ON x.source = a JOIN near y ON y.source = x.target AND y.target = b GROUP BY a, b),
r3 AS (SELECT a, b, 3 AS hops, min(a || ' - ' || x.target || ' - ' || y.target || ' - ' || b) AS path FROM p JOIN near x ON x.source = a JOIN near y ON y.source = x.target JOIN near z ON z.source = y.target AND z.target = b GROUP BY a, b)
SELECT a, b, min(hops) AS hops, arg_min(path, hops) AS path FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) GROUP BY a, b""")
def shortest_paths(spark: SparkSession, base: str) -> DataFrame:
    """Shortest paths of up to three hops between the most mentioned concepts."""
    s = _seeds(spark, base)
    pairs = s.select(F.col("node").alias("a")).join(s.select(F.col("node").alias("b")), F.col("a") < F.col("b"))
    return G.shortest_paths(_edges(spark, base).where(F.col("relation").isin(EXPANSION)), pairs, 3)


@query(V.sql("g_concept") + """SELECT p.concept_id AS parent_id, p.canonical_name AS parent, count(c.concept_id) AS subtypes, coalesce(min(c.canonical_name), '') AS first_subtype FROM g_concept p JOIN g_concept c ON c.broader_concept_id = p.concept_id GROUP BY ALL""")
def subtypes_parents(spark: SparkSession, base: str) -> DataFrame:
    """Parents with the number of their subtypes and the first of them."""
    c = V.concepts(spark, base)
    child = c.select(F.col("broader_concept_id").alias("parent_id"), F.col("concept_id").alias("child"), F.col("canonical_name").alias("child_name"))
    parent = c.select(F.col("concept_id").alias("parent_id"), F.col("canonical_name").alias("parent"))
    return parent.join(child, "parent_id").groupBy("parent_id", "parent").agg(F.count("child").alias("subtypes"), F.coalesce(F.min("child_name"), F.lit("")).alias("first_subtype"))


@query(V.sql("g_concept") + "SELECT concept_id, canonical_name, short_definition, chapter_id FROM g_concept")
def all_concepts(spark: SparkSession, base: str) -> DataFrame:
    """All concepts by name."""
    return V.concepts(spark, base, "concept_id", "canonical_name", "short_definition", "chapter_id").select("concept_id", "canonical_name", "short_definition", "chapter_id").orderBy("canonical_name", "concept_id")


@query(V.sql("g_prereq", recursive=True) + """, reach(s, t) AS (SELECT source, target FROM g_prereq UNION SELECT r.s, p.target FROM reach r JOIN g_prereq p ON p.source = r.t)
SELECT g.target AS source, g.source AS target, r.s IS NOT NULL AS reaches FROM g_prereq g LEFT JOIN reach r ON r.s = g.target AND r.t = g.source""")
def reachability(spark: SparkSession, base: str) -> DataFrame:
    """For every prerequisite edge, whether its target leads back to its source."""
    p = V.prerequisites(spark, base)
    return G.reachable(p, p.select(F.col("target").alias("source"), F.col("source").alias("target")))


@query(V.sql("g_prereq", recursive=True) + """, fwd(s, t) AS (SELECT source, target FROM g_prereq UNION SELECT f.s, p.target FROM fwd f JOIN g_prereq p ON p.source = f.t),
loops AS (SELECT s FROM fwd WHERE s = t), down AS (SELECT DISTINCT t AS node FROM fwd WHERE s IN (SELECT s FROM loops)), up AS (SELECT DISTINCT s AS node FROM fwd WHERE t IN (SELECT s FROM loops))
SELECT source, target FROM g_prereq WHERE source IN (SELECT node FROM down INTERSECT SELECT node FROM up) AND target IN (SELECT node FROM down INTERSECT SELECT node FROM up)""")
def cycle_check(spark: SparkSession, base: str) -> DataFrame:
    """Prerequisite edges that lie on or between loops."""
    return G.cyclic_core(V.prerequisites(spark, base))


@query()
def dag_admission(spark: SparkSession, base: str) -> DataFrame:
    """Prerequisite edges admitted by falling confidence as long as no loop closes."""
    return G.admit_acyclic(_weighted(spark, base))


@query()
def transitive_reduction(spark: SparkSession, base: str) -> DataFrame:
    """Direct edges of the admitted layer."""
    return G.direct_edges(G.admit_acyclic(_weighted(spark, base)).where("admitted"))


@query(V.sql("g_prereq") + """, f AS (SELECT source, target FROM g_prereq WHERE source < target)
SELECT source, target FROM f EXCEPT SELECT a.source, b.target FROM f a JOIN f b ON a.target = b.source
EXCEPT SELECT a.source, c.target FROM f a JOIN f b ON a.target = b.source JOIN f c ON b.target = c.source
EXCEPT SELECT a.source, d.target FROM f a JOIN f b ON a.target = b.source JOIN f c ON b.target = c.source JOIN f d ON c.target = d.source
EXCEPT SELECT a.source, x.target FROM f a JOIN f b ON a.target = b.source JOIN f c ON b.target = c.source JOIN f d ON c.target = d.source JOIN f x ON d.target = x.source""")
def direct_prerequisites(spark: SparkSession, base: str) -> DataFrame:
    """G12 over prerequisites whose source comes first in name order, which are acyclic by that order."""
    return G.direct_edges(V.prerequisites(spark, base).where("source < target"))


_SCORED = "s AS (SELECT source, target, relation, max(confidence) AS score FROM e WHERE source <> target GROUP BY 1, 2, 3)"


def _scored(spark: SparkSession, base: str) -> DataFrame:
    return _edges(spark, base).where("source <> target").groupBy("source", "target", "relation").agg(F.max("confidence").alias("score"))


@query(V.sql("g_relation") + f", {_REL}, {_SCORED}" + " SELECT source, target, relation, round(score, 6) AS score, row_number() OVER (PARTITION BY relation, least(source, target), greatest(source, target) ORDER BY score DESC, source, target) = 1 AS kept FROM s")
def bidirectional_resolve(spark: SparkSession, base: str) -> DataFrame:
    """One direction of each pair and relation."""
    return G.resolve_opposites(_scored(spark, base)).select("source", "target", "relation", F.round("score", 6).alias("score"), "kept")


@query()
def cycle_break(spark: SparkSession, base: str) -> DataFrame:
    """Edges removed from hierarchies of relations until they have no loop."""
    e = _scored(spark, base).where("relation IN ('HAS_SUBTYPE', 'PART_OF')").withColumnRenamed("score", "strength")
    s = table(spark, base, "subtype_edges").where("parent <> child").select(F.col("parent").alias("source"), F.col("child").alias("target"), F.lit("HAS_SUBTYPE").alias("relation"), F.lit(1.0).alias("strength")).distinct()
    return G.break_cycles(e.union(s.select(e.columns)))


@query(V.sql("g_relation") + f", {_REL}" + " SELECT DISTINCT a.relation_id FROM e a JOIN e b ON a.source = b.target AND a.target = b.source AND a.relation = b.relation")
def reciprocal_edges(spark: SparkSession, base: str) -> DataFrame:
    """Relations that exist both ways."""
    return G.reciprocal(_edges(spark, base)).select("relation_id").distinct()


@query(V.sql("g_relation") + f", {_REL}" + " SELECT relation_id FROM e WHERE relation = 'USES' AND EXISTS (SELECT 1 FROM e s WHERE s.source = e.source AND s.target = e.target AND s.relation IN ('INVOKES', 'SCHEDULES', 'CREATES', 'LOADS_FROM'))")
def specific_shadowing(spark: SparkSession, base: str) -> DataFrame:
    """General relations behind which a specific one stands."""
    return G.shadowed(_edges(spark, base), "USES", ["INVOKES", "SCHEDULES", "CREATES", "LOADS_FROM"]).select("relation_id")


_ALIAS = """al AS (SELECT child AS alias, min(parent) AS canonical FROM subtype_edges WHERE child IS NOT NULL AND parent IS NOT NULL AND child <> parent GROUP BY child)"""


def _aliases(spark: SparkSession, base: str) -> DataFrame:
    s = table(spark, base, "subtype_edges").where("child IS NOT NULL AND parent IS NOT NULL AND child <> parent")
    return s.groupBy(F.col("child").alias("alias")).agg(F.min("parent").alias("canonical"))


@query(V.sql("g_prereq") + f", {_ALIAS}" + " SELECT DISTINCT coalesce(a.canonical, source) AS source, coalesce(b.canonical, target) AS target FROM g_prereq LEFT JOIN al a ON a.alias = source LEFT JOIN al b ON b.alias = target WHERE coalesce(a.canonical, source) <> coalesce(b.canonical, target)")
def alias_one_level(spark: SparkSession, base: str) -> DataFrame:
    """Prerequisites with names replaced by their parents', one level deep."""
    return G.substitute(V.prerequisites(spark, base), _aliases(spark, base), ["source", "target"]).where("source <> target").distinct()


@query("WITH " + _ALIAS + ", " + _WEIGHTED + " SELECT coalesce(a.canonical, source) AS source, coalesce(b.canonical, target) AS target, sum(1) AS n, round(max(confidence), 6) AS confidence FROM w LEFT JOIN al a ON a.alias = source LEFT JOIN al b ON b.alias = target WHERE coalesce(a.canonical, source) <> coalesce(b.canonical, target) GROUP BY 1, 2")
def alias_merge(spark: SparkSession, base: str) -> DataFrame:
    """Prerequisites re-pointed to canonical nodes, coinciding ones added up."""
    e = _weighted(spark, base).withColumn("n", F.lit(1).cast("long"))
    return G.merge_nodes(e, _aliases(spark, base), [], ["n"], ["confidence"]).withColumn("confidence", F.round("confidence", 6))


@query("""WITH n AS (SELECT DISTINCT unnest([name, canonical_name, lower(name), 'x']) AS name FROM concepts), k AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS key, length(regexp_replace(substr(name, 2), '[^A-Z]', '', 'g')) AS caps FROM n WHERE name IS NOT NULL),
b AS (SELECT *, first_value(name) OVER (PARTITION BY key ORDER BY caps DESC, length(name) DESC, name) AS canonical, count(*) OVER (PARTITION BY key) AS m FROM k) SELECT name AS alias, canonical FROM b WHERE m > 1 AND name <> canonical""")
def fast_merge(spark: SparkSession, base: str) -> DataFrame:
    """Spellings of one name and the one that stays."""
    names = table(spark, base, "concepts").select(F.explode(F.array("name", "canonical_name", F.lower("name"), F.lit("x"))).alias("name"))
    return G.collapsed_names(names)


@query(V.sql("g_concept") + ", up AS (SELECT concept_id, broader_concept_id FROM g_concept WHERE broader_concept_id IS NOT NULL)" + " SELECT c.concept_id, c.canonical_name, count(DISTINCT k.concept_id) AS children, count(DISTINCT s.concept_id) AS siblings FROM g_concept c LEFT JOIN up k ON k.broader_concept_id = c.concept_id LEFT JOIN up me ON me.concept_id = c.concept_id LEFT JOIN up s ON s.broader_concept_id = me.broader_concept_id AND s.concept_id <> c.concept_id GROUP BY ALL")
def concept_neighbourhood(spark: SparkSession, base: str) -> DataFrame:
    """Children and siblings of every concept, counted by parent before any join."""
    c = V.concepts(spark, base, "concept_id", "canonical_name", "broader_concept_id").select("concept_id", "canonical_name", "broader_concept_id")
    held = c.where("broader_concept_id IS NOT NULL").groupBy("broader_concept_id").agg(F.countDistinct("concept_id").alias("n"))
    children = held.select(F.col("broader_concept_id").alias("concept_id"), F.col("n").alias("children"))
    near = c.join(children, "concept_id", "left").join(held, "broader_concept_id", "left")
    return near.select("concept_id", "canonical_name", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce(F.col("n") - 1, F.lit(0)).alias("siblings"))
