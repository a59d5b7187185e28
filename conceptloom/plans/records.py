"""Queries on record keeping: hierarchies and orphan references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy as hier
from ..operators import orphans
from ..session import table


def _layers(spark: SparkSession, base: str) -> DataFrame:
    subtype = hier.layer_edges(table(spark, base, "subtype_edges"), "subtype", "parent", "child")
    return subtype.union(hier.layer_edges(table(spark, base, "prerequisite_edges"), "prereq", "prereq", "target"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    """Hops of every node below every root, and nodes on loops."""
    return hier.hierarchy(_layers(spark, base), "hops")


def p5_paths(spark: SparkSession, base: str) -> DataFrame:
    """Every path from a root to a node, with its depth."""
    return hier.hierarchy(_layers(spark, base), "paths")


def p5_descendants(spark: SparkSession, base: str) -> DataFrame:
    """All descendants of every node."""
    return hier.hierarchy(_layers(spark, base), "descendants")


def p5_back_edges(spark: SparkSession, base: str) -> DataFrame:
    """Edges by which a traversal comes back to a node that is still open."""
    return hier.hierarchy(_layers(spark, base), "back_edges")


def _ledger(spark: SparkSession, base: str) -> orphans.Ledger:
    refs = orphans.references(table(spark, base, "mentions"), "mentions", "mention_id", {"concept_id": "concept", "chunk_id": "chunk"}).union(
        orphans.references(table(spark, base, "relations"), "relations", "relation_id", {"source_concept_id": "concept", "target_concept_id": "concept"})
    )
    parents = orphans.parents(table(spark, base, "concepts"), "concept", "concept_id").union(orphans.parents(table(spark, base, "chunks"), "chunk", "chunk_id"))
    return orphans.replay(refs, parents)


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    """Every reference that fails, with its cause and month."""
    return orphans.found(_ledger(spark, base))


def p6_counts(spark: SparkSession, base: str) -> DataFrame:
    """Orphans per table, field, cause and month at the end."""
    return orphans.counts(_ledger(spark, base).pending)


def p6_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """Orphans per table, field, cause and month after each period of arrival."""
    return reduce(DataFrame.union, _ledger(spark, base).snapshots)


QUERIES = {f.__name__: f for f in (p5_found, p5_paths, p5_descendants, p5_back_edges, p6_found, p6_counts, p6_snapshots)}

_EDGES = """
WITH RECURSIVE e AS (
  SELECT DISTINCT 'subtype' AS layer, parent, child FROM subtype_edges WHERE parent IS NOT NULL AND child IS NOT NULL
  UNION SELECT DISTINCT 'prereq', prereq, target FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL
), nodes AS (SELECT layer, parent AS node FROM e UNION SELECT layer, child FROM e),
reach(layer, s, t) AS (SELECT layer, parent, child FROM e UNION SELECT r.layer, r.s, e.child FROM reach r JOIN e ON e.layer = r.layer AND e.parent = r.t)
"""

_REFS = """
WITH refs AS (
  SELECT 'mentions' AS ref_table, 'concept_id' AS ref_field, mention_id AS row_id, concept_id AS k, 'concept' AS kind, created_at FROM mentions
  UNION ALL SELECT 'mentions', 'chunk_id', mention_id, chunk_id, 'chunk', created_at FROM mentions
  UNION ALL SELECT 'relations', 'source_concept_id', relation_id, source_concept_id, 'concept', created_at FROM relations
  UNION ALL SELECT 'relations', 'target_concept_id', relation_id, target_concept_id, 'concept', created_at FROM relations
), rows_of AS (
  SELECT 'concept' AS kind, concept_id AS k, created_at, deleted_at, loaded_at FROM concepts WHERE concept_id IS NOT NULL
  UNION ALL SELECT 'chunk', chunk_id, created_at, deleted_at, loaded_at FROM chunks WHERE chunk_id IS NOT NULL
), present AS (
  SELECT kind, k, min(created_at) AS first_created, arg_max(deleted_at IS NOT NULL, (loaded_at, deleted_at IS NOT NULL)) AS deleted FROM rows_of GROUP BY kind, k
), judged AS (
  SELECT ref_table, ref_field, row_id, refs.k, strftime(refs.created_at, '%Y-%m') AS m,
    CASE WHEN deleted IS NULL THEN 'missing' WHEN deleted THEN 'deleted' WHEN first_created > refs.created_at THEN 'late' END AS cause
  FROM refs LEFT JOIN present ON present.kind = refs.kind AND present.k = refs.k WHERE refs.k IS NOT NULL
)
"""

ORACLES = {
    "p5_descendants": _EDGES + """, walk AS (
  SELECT layer, s, t FROM reach WHERE s <> t
) SELECT w.layer, w.s AS node, w.t AS descendant, d.hops FROM walk w JOIN (
  WITH RECURSIVE h(layer, s, t, hops) USING KEY (layer, s, t) AS (
    SELECT layer, node, node, 0 FROM nodes
    UNION SELECT h.layer, h.s, e.child, h.hops + 1 FROM h JOIN e ON e.layer = h.layer AND e.parent = h.t
      LEFT JOIN recurring.h AS k ON k.layer = h.layer AND k.s = h.s AND k.t = e.child WHERE k.hops IS NULL
  ) SELECT * FROM h) d ON d.layer = w.layer AND d.s = w.s AND d.t = w.t""",
    "p6_found": _REFS + "SELECT DISTINCT ref_table, ref_field, row_id, cause, coalesce(m, 'unknown') AS ref_month FROM judged WHERE cause IS NOT NULL",
    "p6_counts": _REFS + """SELECT ref_table, ref_field, cause, coalesce(m, 'unknown') AS ref_month, count(DISTINCT (row_id, k)) AS orphans
FROM judged WHERE cause IS NOT NULL GROUP BY ALL""",
}
ORACLES["p5_found"] = _EDGES + """, tops AS (
  SELECT layer, node FROM nodes EXCEPT SELECT layer, child FROM e WHERE parent <> child
) SELECT layer, node, root_name, hops FROM (
  WITH RECURSIVE h(layer, s, t, hops) USING KEY (layer, s, t) AS (
    SELECT layer, node, node, 0 FROM tops
    UNION SELECT h.layer, h.s, e.child, h.hops + 1 FROM h JOIN e ON e.layer = h.layer AND e.parent = h.t
      LEFT JOIN recurring.h AS k ON k.layer = h.layer AND k.s = h.s AND k.t = e.child WHERE k.hops IS NULL
  ) SELECT layer, t AS node, s AS root_name, hops FROM h)
UNION ALL SELECT layer, s, 'CYCLE', -1 FROM reach WHERE s = t"""
