"""Views of the input tables that several queries share, and the same views as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

#: Columns without the embedding, of the present state of a key.
CONCEPT = "concept_id canonical_name name name_zh short_definition aliases status chapter_id chapter_role broader_concept_id retrieval_enabled retrieval_weight evidence_count local_kp_ids created_at deleted_at loaded_at".split()
CHUNK = "chunk_id parent_chunk_id chapter_id text pages sections primary_section page_start page_end excluded_tail_chars seq created_at deleted_at loaded_at".split()
MENTION = "mention_id concept_id chunk_id quote evidence_type confidence created_at loaded_at".split()
RELATION = "relation_id source_concept_id target_concept_id relation evidence source_chunks confidence_max verification_status verification_reason created_at loaded_at".split()

# Ties of loaded_at fall by these, so that both engines choose one state.
_TIES = {"concepts": ["created_at", "deleted_at", "status", "chapter_id", "chapter_role"], "chunks": ["created_at", "deleted_at", "seq"], "mentions": ["created_at", "evidence_type", "confidence"], "relations": ["created_at", "relation", "confidence_max"]}
_KEYS = {"concepts": "concept_id", "chunks": "chunk_id", "mentions": "mention_id", "relations": "relation_id"}
_COLUMNS = {"concepts": CONCEPT, "chunks": CHUNK, "mentions": MENTION, "relations": RELATION}


def present(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """The present row of each key of concepts, chunks, mentions or relations; rows without a key are left out.

    columns: those that are needed, all but the embedding by default. The aggregation hides them from column
    pruning, so callers that need few say so, and only these are read and shuffled.
    """
    key = _KEYS[name]
    wanted = [c for c in _COLUMNS[name] if not columns or c in columns or c == key]
    order = F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ["loaded_at", *_TIES[name]]))
    rows = table(spark, base, name).where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by(F.struct(*wanted), order).alias("_row")).select("_row.*")


def _undeleted(spark: SparkSession, base: str, name: str, columns: tuple[str, ...]) -> DataFrame:
    rows = present(spark, base, name, *columns, *(["deleted_at"] if columns else [])).where("deleted_at IS NULL")
    return rows.select(*dict.fromkeys([_KEYS[name], *columns])) if columns else rows


def concepts(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """Concepts that are not deleted, in their present state."""
    return _undeleted(spark, base, "concepts", columns)


def chunks(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """Chunks that are not deleted, in their present state."""
    return _undeleted(spark, base, "chunks", columns)


def mentions(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """Each mention once, with both keys, its type in lower case and its confidence within 0 and 1."""
    from ..functions.text import clamp

    kind = F.lower(F.trim("evidence_type"))
    rows = present(spark, base, "mentions", *columns, *(["concept_id", "chunk_id"] if columns else [])).where("concept_id IS NOT NULL AND chunk_id IS NOT NULL")
    if "evidence_type" in rows.columns:
        rows = rows.withColumn("evidence_type", F.when(kind.isin("definition", "example", "usage", "mention"), kind))
    if "confidence" in rows.columns:
        rows = rows.withColumn("confidence", clamp(F.col("confidence")))
    return rows


def relations(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """Each relation once, with both ends, its type in upper case and its confidence within 0 and 1."""
    from ..functions.text import clamp

    ends = ["source_concept_id", "target_concept_id"]
    rows = present(spark, base, "relations", *columns, *([*ends, "relation", "confidence_max"] if columns else [])).where("source_concept_id IS NOT NULL AND target_concept_id IS NOT NULL")
    return rows.withColumn("relation", F.upper(F.trim("relation"))).withColumn("confidence", clamp(F.col("confidence_max")))


def _sql_present(name: str) -> str:
    key = _KEYS[name]
    order = ", ".join(f"coalesce({c}::VARCHAR, '') DESC" for c in ["loaded_at", *_TIES[name]])
    return f"SELECT {', '.join(_COLUMNS[name])} FROM {name} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


_CLAMP = "CASE WHEN {0} IS NULL OR isnan({0}) OR isinf({0}) THEN 0.0 ELSE greatest(0.0, least(1.0, {0})) END"
_VIEWS = {
    "g_concept": f"SELECT * FROM ({_sql_present('concepts')}) WHERE deleted_at IS NULL",
    "g_chunk": f"SELECT * FROM ({_sql_present('chunks')}) WHERE deleted_at IS NULL",
    "g_mention": f"SELECT * REPLACE (CASE WHEN lower(trim(evidence_type)) IN ('definition', 'example', 'usage', 'mention') THEN lower(trim(evidence_type)) END AS evidence_type, {_CLAMP.format('confidence')} AS confidence) FROM ({_sql_present('mentions')}) WHERE concept_id IS NOT NULL AND chunk_id IS NOT NULL",
    "g_relation": f"SELECT * REPLACE (upper(trim(relation)) AS relation), {_CLAMP.format('confidence_max')} AS confidence FROM ({_sql_present('relations')}) WHERE source_concept_id IS NOT NULL AND target_concept_id IS NOT NULL",
    "g_prereq": "SELECT DISTINCT prereq AS source, target FROM prerequisite_edges WHERE prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target",
}


def prerequisites(spark: SparkSession, base: str) -> DataFrame:
    """Distinct prerequisite edges between different names: ``source``, ``target``."""
    return table(spark, base, "prerequisite_edges").where("prereq IS NOT NULL AND target IS NOT NULL AND prereq <> target").select(F.col("prereq").alias("source"), "target").distinct()


def sql(*names: str, recursive: bool = False) -> str:
    """The WITH clause of some views."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in names)
