"""Registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from . import cohesion, encoding, groups, neighbours, packing, scans, sentences


def p7_ids(spark: SparkSession, base: str) -> DataFrame:
    """Ids of every document."""
    return encoding.encode_corpus(table(spark, base, "documents"))


def p7_token_counts(spark: SparkSession, base: str) -> DataFrame:
    """Number of ids of every document."""
    return encoding.count_tokens(table(spark, base, "documents"))


def p8_containers(spark: SparkSession, base: str) -> DataFrame:
    """Every document's place in containers of 2,048 tokens."""
    return packing.pack_corpus(table(spark, base, "documents"))


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    """Sentence units of every document."""
    return sentences.split_sentences(table(spark, base, "documents"))


def p9_sentences(spark: SparkSession, base: str) -> DataFrame:
    """Sentence units of every document with their text."""
    return sentences.split_sentences(table(spark, base, "documents"), with_text=True)


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    """Chunks above the size limit: those with a piece that is not their whole text."""
    split = cohesion.split_sections(table(spark, base, "section_chunks"))
    return split.where("end_char - start_char < source_chars").select("chunk_id").distinct()


def p1_pieces(spark: SparkSession, base: str) -> DataFrame:
    """Pieces of the present state of every section chunk."""
    return cohesion.split_sections(cohesion.latest_rows(table(spark, base, "section_chunks"), "chunk_id"))


def p1_invariants(spark: SparkSession, base: str) -> DataFrame:
    """What must hold of every chunk's pieces: size, overlap, cover and pages."""
    latest = cohesion.latest_rows(table(spark, base, "section_chunks"), "chunk_id")
    pieces = cohesion.split_sections(latest)
    order = Window.partitionBy("chunk_id").orderBy("piece")
    placed = pieces.withColumn("before", F.lag("end_char").over(order)).join(latest.select("chunk_id", F.col("text").alias("source"), F.when(F.col("page_start").isNotNull() & F.col("page_end").isNotNull(), F.array_sort(F.array("page_start", "page_end"))).alias("bounds")), "chunk_id")
    gap = F.expr("substring(source, coalesce(before, 0) + 1, start_char - coalesce(before, 0))")
    return placed.groupBy("chunk_id").agg(
        F.max("source_chars").alias("source_chars"),
        F.count_if(F.length("text") > 2400).cast("long").alias("too_long"),
        F.count_if(F.col("before") - F.col("start_char") > 300).cast("long").alias("overlap_too_long"),
        F.count_if(gap.rlike("(?U)\\S")).cast("long").alias("left_out"),
        F.count_if(F.col("text") != F.expr("substring(source, start_char + 1, end_char - start_char)")).cast("long").alias("not_in_place"),
        F.max_by(F.expr("substring(source, end_char + 1)").rlike("(?U)\\S"), "piece").cast("long").alias("tail_left_out"),
        F.count_if((F.col("page_start") < F.col("bounds")[0]) | (F.col("page_end") > F.col("bounds")[1]) | (F.col("page_start") > F.col("page_end"))).cast("long").alias("pages_out"),
    )


def _vectors(spark: SparkSession, base: str) -> DataFrame:
    concepts = neighbours.usable_vectors(table(spark, base, "concepts"), "concept_id", "concept")
    return concepts.union(neighbours.usable_vectors(table(spark, base, "chunks"), "chunk_id", "chunk"))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of concepts and pairs of chunks with a cosine of 0.90 or more."""
    return neighbours.similar_pairs(_vectors(spark, base), 0.9)


def p2_nearest(spark: SparkSession, base: str) -> DataFrame:
    """The ten most similar others of every concept and every chunk."""
    return neighbours.nearest(_vectors(spark, base), 10)


def p2_index(spark: SparkSession, base: str) -> DataFrame:
    """Shape of the index of each kind, and the share of planted pairs at a cosine of 0.90 that it retrieves."""
    return neighbours.index_report(_vectors(spark, base))


def _titles(spark: SparkSession, base: str) -> list[str]:
    """Titles of books and chapters: a reference list of fixed size, checked before it is sent."""
    chapters = table(spark, base, "chapters")
    names = chapters.select("title").union(chapters.select("book_title")).where(F.length("title") > 0).distinct().limit(10_001)
    found = sorted(r[0] for r in names.collect())
    if len(found) > 10_000:
        raise ValueError("chapters is not the small reference list it should be")
    return found


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    """Kinds of noise in every chunk."""
    return scans.find_noise(table(spark, base, "section_chunks"), table(spark, base, "chunks"), _titles(spark, base))


def p3_text(spark: SparkSession, base: str) -> DataFrame:
    """Every chunk's text without what the page scan left in it."""
    return scans.clean_texts(table(spark, base, "section_chunks"), table(spark, base, "chunks"), _titles(spark, base))


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """Every name of a same verdict with the smallest name of its group."""
    verdicts = groups.same_verdicts(table(spark, base, "merge_decisions"))
    return groups.connected_groups(verdicts).select(F.col("member").alias("concept_name"), F.col("group_id").alias("group_name"))


P2_SQL = """
WITH v AS (
  SELECT 'concept' AS kind, concept_id AS id, any_value(embedding)::DOUBLE[] AS e FROM concepts GROUP BY concept_id
  UNION ALL SELECT 'chunk', chunk_id, any_value(embedding)::DOUBLE[] FROM chunks GROUP BY chunk_id
), u AS (
  SELECT * FROM v WHERE id IS NOT NULL AND len(e) = 64 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64
  AND len(list_filter(e, lambda x: x <> 0)) > 0
)
SELECT a.kind, a.id AS id_a, b.id AS id_b FROM u a JOIN u b ON a.kind = b.kind AND a.id < b.id
WHERE list_cosine_similarity(a.e, b.e) >= 0.9 - 1e-9
"""

P4_SQL = """
WITH RECURSIVE links AS (
  SELECT a AS u, b AS v FROM merge_decisions WHERE lower(regexp_replace(relation, '^\\s+|\\s+$', '', 'g')) = 'same' AND a IS NOT NULL AND b IS NOT NULL
), both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(s, t) AS (SELECT u, u FROM both_ways UNION SELECT r.s, e.v FROM reach r JOIN both_ways e ON e.u = r.t)
SELECT s AS concept_name, min(t) AS group_name FROM reach GROUP BY s
"""


QUERIES = {f.__name__: f for f in (p1_found, p1_pieces, p1_invariants, p2_found, p2_nearest, p2_index, p3_found, p3_text, p4_found, p7_ids, p7_token_counts, p8_containers, p9_found, p9_sentences)}
ORACLES: dict[str, str] = {
    "p1_found": "SELECT DISTINCT chunk_id FROM section_chunks WHERE length(text) > 2400",
    "p1_invariants": """SELECT chunk_id, length(text)::INT AS source_chars, 0 AS too_long, 0 AS overlap_too_long, 0 AS left_out, 0 AS not_in_place, 0 AS tail_left_out, 0 AS pages_out
FROM section_chunks WHERE chunk_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY loaded_at DESC) = 1 AND length(text) > 0""",
    "p2_found": P2_SQL,
    "p4_found": P4_SQL,
}
