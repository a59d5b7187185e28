"""Readers and writers of the nested documents: registries, local knowledge points, graphs, logs, pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY = "registry_type STRING, concepts ARRAY<STRUCT<concept_id STRING, canonical_name STRING, aliases ARRAY<STRING>, name_zh STRING, short_definition STRING, status STRING, broader_concept_id STRING, primary_section STRING, evidence_sections ARRAY<STRING>, canonical_owner_chapter STRING>>"
BRIDGE = "chapter STRING, sections ARRAY<STRUCT<section STRING, title STRING, source_pdf_pages ARRAY<INT>, knowledge_points ARRAY<STRUCT<id STRING, name STRING, aliases ARRAY<STRING>, concept_type STRING, definition STRING, primary_section STRING, also_discussed_in ARRAY<STRING>, source_pdf_pages ARRAY<INT>>>>>"
GRAPH = (
    "schema_version STRING, validation_summary STRUCT<validation_status STRING, new_concept_candidates INT, unresolved_local_kps INT>, "
    "concepts ARRAY<STRUCT<concept_id STRING, canonical_name STRING, name_zh STRING, short_definition STRING, aliases ARRAY<STRING>, status STRING, chapter_role STRING, retrieval_enabled BOOLEAN, retrieval_weight DOUBLE, evidence_count INT, local_kp_ids ARRAY<STRING>>>, "
    "chunks ARRAY<STRUCT<chunk_id STRING, text STRING, pages ARRAY<INT>, page_start INT, page_end INT, primary_section STRING>>, "
    "mentions ARRAY<STRUCT<concept_id STRING, chunk_id STRING, quote STRING, evidence_type STRING, confidence DOUBLE>>, "
    "relations ARRAY<STRUCT<source_concept_id STRING, target_concept_id STRING, relation STRING, evidence ARRAY<STRUCT<chunk_id STRING, quote STRING>>, source_chunks ARRAY<STRING>, confidence_max DOUBLE, verification_status STRING, verification_reason STRING>>, "
    "pedagogical_prerequisites ARRAY<STRUCT<source_concept_id STRING, target_concept_id STRING, relation STRING, confidence DOUBLE>>"
)


def _whole(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_registry(spark: SparkSession, path: str, registry_type: str = "GLOBAL", prefix: str = "OS_") -> DataFrame:
    """Approved concepts of a registry; another type, a foreign id or a repeated id is an error."""
    raw = _whole(spark, path, REGISTRY)
    if raw.where(~F.col("registry_type").eqNullSafe(registry_type)).limit(1).count():
        raise ValueError(f"not a registry of type {registry_type}")
    rows = raw.select(F.explode("concepts").alias("c")).select("c.*")
    bad = rows.groupBy("concept_id").count().where((F.col("count") > 1) | ~F.coalesce(F.col("concept_id").startswith(prefix), F.lit(False))).limit(5).collect()
    if bad:
        raise ValueError(f"repeated or foreign ids: {[r[0] for r in bad]}")
    return rows.where("status = 'APPROVED'")


def registry_names(concepts: DataFrame) -> DataFrame:
    """``concept_id``, ``term`` of every name and alias."""
    return concepts.select("concept_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term")).where("term IS NOT NULL").distinct()


def read_bridge(spark: SparkSession, path: str) -> DataFrame:
    """Local knowledge points with their section, one row each."""
    s = _whole(spark, path, BRIDGE).select("chapter", F.explode("sections").alias("s"))
    return s.select("chapter", F.col("s.section").alias("section"), F.col("s.title").alias("title"), F.explode("s.knowledge_points").alias("k")).select("chapter", "section", "title", "k.*")


def resolve_terms(points: DataFrame, terms: DataFrame) -> DataFrame:
    """H1, H2: ``term``, ``id``: by name first, then by an alias that only one point bears and no point has as name."""
    names = points.select(F.lower("name").alias("key"), F.col("id").alias("by_name")).distinct()
    aliases = points.select("id", F.explode("aliases").alias("a")).select("id", F.lower("a").alias("key")).distinct()
    single = aliases.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("id").alias("by_alias")).where("n = 1").join(names, "key", "left_anti")
    asked = terms.select("term", F.lower("term").alias("key")).distinct()
    return asked.join(names, "key", "left").join(single.select("key", "by_alias"), "key", "left").select("term", F.coalesce("by_name", "by_alias").alias("id"))


def points_of_section(points: DataFrame, section: str, cross: bool = True) -> DataFrame:
    """H3: points of a section, its own first, then those discussed there too."""
    own = points.where(F.col("primary_section") == section).select("id", F.lit(0).alias("rank"))
    if not cross:
        return own
    other = points.where(F.array_contains("also_discussed_in", section)).select("id", F.lit(1).alias("rank"))
    return own.union(other).groupBy("id").agg(F.min("rank").alias("rank"))


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A graph document as one table per list; missing lists give empty tables."""
    raw = _whole(spark, path, GRAPH)
    out = {"header": raw.select("schema_version", "validation_summary.*")}
    for name in ("concepts", "chunks", "mentions", "relations", "pedagogical_prerequisites"):
        out[name] = raw.select(F.explode(name).alias("r")).select("r.*")
    return out


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``local``, ``concept_id`` of a JSON object, or of its member ``mappings``."""
    text = spark.read.text(path, wholetext=True).select(F.col("value"))
    plain = F.from_json("value", "map<string,string>")
    inner = F.from_json(F.get_json_object("value", "$.mappings"), "map<string,string>")
    return text.select(F.explode(F.coalesce(inner, plain)).alias("local", "concept_id"))


def read_log(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The last good record of each key of a log of JSON lines; ``seq`` tells the order, broken lines are skipped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col(key).isNotNull())
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), "seq").alias("r"))
    return last.select("r.*")


def append_log(rows: DataFrame, path: str) -> None:
    """Append records to a log."""
    rows.write.mode("append").json(path)


def curated(spark: SparkSession, path: str, known: DataFrame, allowed: list[str]) -> DataFrame:
    """Curated relations with known ends and allowed types, as JSON lines."""
    rows = spark.read.schema("source_concept_id STRING, target_concept_id STRING, relation STRING, confidence DOUBLE").json(path)
    ids = known.select("concept_id")
    for end in ("source_concept_id", "target_concept_id"):
        rows = rows.join(ids.withColumnRenamed("concept_id", end), end, "left_semi")
    return rows.where(F.upper("relation").isin(allowed))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as ``path``, ``page``, ``text``: text files with form feeds between pages."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\\f")).alias("n", "text"))
    return files.select("path", (F.col("n") + 1).alias("page"), "text")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def write_graph(tables: dict[str, DataFrame], path: str, version: str) -> None:
    """A graph as one parquet table per list, and a manifest of what was written."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(version, json.dumps(sorted(tables)))], "schema_version STRING, tables STRING").coalesce(1).write.mode("append").json(f"{path}/manifest")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The table itself, or an error that names some repeated keys."""
    bad = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"keys occur more than once: {[tuple(r)[:-1] for r in bad]}")
    return df


def audit_report(candidates: DataFrame, decisions: DataFrame, path: str | None = None) -> str:
    """A short Markdown report of audit candidates by kind and of decisions by action."""
    kinds = candidates.groupBy("kind").count().orderBy("kind").collect()
    actions = decisions.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.count_if("evidence_verified").alias("verified")).orderBy("action").collect()
    lines = ["# Audit", "", "| kind | candidates |", "| --- | --- |", *(f"| {r[0]} | {r[1]} |" for r in kinds), "", "| action | decisions | verified |", "| --- | --- | --- |", *(f"| {r[0]} | {r[1]} | {r[2]} |" for r in actions)]
    text = "\n".join(lines) + "\n"
    if path:
        with open(path, "w", encoding="utf-8") as out:
            out.write(text)
    return text
