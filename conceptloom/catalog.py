"""All queries of the library outside the optional package, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import chunk_queries, gate_queries, graph_queries, merge_queries, records, retrieval_queries, review_queries, text_queries

MODULES = [records, text_queries, graph_queries, merge_queries, retrieval_queries, gate_queries, review_queries, chunk_queries]


def flagship(spark: SparkSession, base: str) -> DataFrame:
    """Hybrid retrieval: vector seeds, graph expansion and evidence in one ranked table."""
    return retrieval_queries.hybrid_retrieve(spark, base)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
