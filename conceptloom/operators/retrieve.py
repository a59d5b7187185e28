"""Composite retrieval: seeds by vector, expansion in the graph, evidence, chains and paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import graph as G
from . import vectors as X


@dataclass(frozen=True)
class Limits:
    """Sizes and weights of a retrieval; the defaults are fixed values."""

    top_k: int = 5
    top_m: int = 6
    hops: int = 2
    expanded: int = 40
    chunks: int = 12
    chain_depth: int = 3
    chain_rows: int = 10
    mention_weight: float = 0.7


def clamp_limits(top_k: int, depth: int) -> tuple[int, int]:
    """``top_k`` within 1 and 20, ``depth`` within 1 and 4."""
    return max(1, min(20, top_k)), max(1, min(4, depth))


def hybrid(query: list[float], concepts: DataFrame, chunks: DataFrame, mentions: DataFrame, relations: DataFrame, types: list[str], limits: Limits = Limits()) -> dict[str, DataFrame]:
    """``concepts`` (concept_id, score, origin) and ``chunks`` (chunk_id, score, origin) for a query vector.

    Concepts come from the vector search, from the chunks it finds (0.7 of their score), and from the graph
    (0.5/distance); the first of these origins holds for a concept. Chunks come from the vector search and from
    the mentions of the concepts found (0.3 + 0.05 for each). Only the best few rows of each step are kept, and
    these small tables are what joins broadcast.
    """
    hits = cut(X.top_k(chunks, query, limits.top_k, "chunk_id").select("chunk_id", "score"))
    direct = cut(X.top_k(concepts, query, limits.top_m, "concept_id").select("concept_id", "score"))
    said = mentions.join(F.broadcast(hits), "chunk_id").groupBy("concept_id").agg((F.max("score") * limits.mention_weight).alias("score"))
    seeds = cut(direct.withColumn("o", F.lit(0)).union(said.withColumn("o", F.lit(1))))
    edges = relations.where(F.col("relation").isin(types)).select(F.col("source_concept_id").alias("source"), F.col("target_concept_id").alias("target"))
    near = G.expand(edges, seeds.select(F.col("concept_id").alias("node")), limits.hops).orderBy("dist", "node").limit(limits.expanded)
    found = seeds.union(near.select("node", "score", F.lit(2)))
    best = found.groupBy("concept_id").agg(F.min_by(F.struct("score", "o"), F.struct("o", -F.col("score"))).alias("b"))
    origin = F.element_at(F.array(F.lit("vector"), F.lit("chunk_mention"), F.lit("graph_expand")), F.col("b.o") + 1)
    ranked = cut(best.select("concept_id", F.col("b.score").alias("score"), origin.alias("origin")))
    proof = evidence_chunks(mentions, ranked.select("concept_id"), hits.select("chunk_id"), limits.chunks)
    evidence = hits.withColumn("origin", F.lit("vector")).union(proof.select("chunk_id", "score", F.lit("graph_expand")))
    return {"concepts": ranked, "chunks": evidence}


def evidence_chunks(mentions: DataFrame, wanted: DataFrame, without: DataFrame, n: int) -> DataFrame:
    """Chunks that mention most of the wanted concepts, without given ones: ``chunk_id``, ``n_concepts``, ``score``."""
    counted = mentions.join(wanted, "concept_id", "left_semi").join(without, "chunk_id", "left_anti").select("chunk_id", "concept_id").distinct().groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_concepts"))
    return counted.orderBy(F.desc("n_concepts"), "chunk_id").limit(n).withColumn("score", F.lit(0.3) + F.lit(0.05) * F.col("n_concepts"))


def context(concepts: DataFrame, mentions: DataFrame, edges: DataFrame, n: int = 3) -> DataFrame:
    """Of each concept its chunks, prerequisites, what it leads to, subtypes and parents, ``n`` of each in name order.

    edges: ``source``, ``target``, ``relation``. Every branch is aggregated before it is joined, so no branch
    multiplies another.
    """
    def some(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
        first = df.select(F.col(key).alias("concept_id"), F.col(value).alias("v")).distinct()
        place = F.row_number().over(Window.partitionBy("concept_id").orderBy("v"))
        kept = first.withColumn("n", place).where(F.col("n") <= n)
        return kept.groupBy("concept_id").agg(F.array_join(F.array_sort(F.collect_list("v")), "|").alias(name))

    sub = edges.where("relation = 'HAS_SUBTYPE'")
    pre = edges.where("relation IN ('USES', 'PART_OF')")
    out = concepts.select("concept_id")
    for part in (some(mentions, "concept_id", "chunk_id", "chunks"), some(pre, "target", "source", "prerequisites"), some(pre, "source", "target", "leads_to"), some(sub, "source", "target", "subtypes"), some(sub, "target", "source", "parents")):
        out = out.join(part, "concept_id", "left")
    return out.na.fill("")
