"""Functions of a retrieval service, each returning a DataFrame; a server is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import graph, retrieve, vectors
from .plans import graph_queries, merge_queries, retrieval_queries, views
from .plans.graph_queries import EXPANSION


class Service:
    """Queries over one data folder."""

    def __init__(self, spark: SparkSession, base: str, embedder: vectors.Embedder | None = None):
        self.spark, self.base = spark, base
        self.embedder = embedder or vectors.HashEmbedder(64)

    def _vector(self, question: str) -> list[float]:
        return [float(x) for x in self.embedder.embed([question])[0]]

    def seeds(self, question: str, top_k: int = 5) -> DataFrame:
        """Concepts nearest to a question."""
        top_k, _ = retrieve.clamp_limits(top_k, 1)
        rows = retrieval_queries._with_vectors(self.spark, self.base, "concepts")
        return vectors.top_k(rows, self._vector(question), top_k, "concept_id").select("concept_id", "canonical_name", "score")

    def retrieve(self, question: str, limits: retrieve.Limits = retrieve.Limits()) -> dict[str, DataFrame]:
        """Concepts and chunks for a question."""
        s, b = self.spark, self.base
        return retrieve.hybrid(self._vector(question), retrieval_queries._with_vectors(s, b, "concepts"), retrieval_queries._with_vectors(s, b, "chunks"), views.mentions(s, b), views.relations(s, b), EXPANSION, limits)

    def semantic_scores(self, question: str, texts: list[str]) -> DataFrame:
        """The score of each text by position; blank texts score 0."""
        q = self.embedder.embed([question])[0]
        scores = [float(v @ q) if t.strip() else 0.0 for t, v in zip(texts, self.embedder.embed(texts))]
        return self.spark.createDataFrame([(i, max(-1.0, min(1.0, s))) for i, s in enumerate(scores)], "pos int, score double").orderBy("pos")

    def concept(self, name: str) -> DataFrame:
        """A concept with its children and siblings counted."""
        return graph_queries.concept_neighbourhood(self.spark, self.base).where(F.col("canonical_name") == name)

    def prerequisites(self, name: str, depth: int = 2) -> DataFrame:
        """What a name builds on."""
        _, depth = retrieve.clamp_limits(1, depth)
        start = self.spark.createDataFrame([(name,)], "node string")
        return graph.walks(views.prerequisites(self.spark, self.base), start, depth, upstream=True)

    def descendants(self, name: str, depth: int = 2) -> DataFrame:
        """What builds on a name."""
        _, depth = retrieve.clamp_limits(1, depth)
        start = self.spark.createDataFrame([(name,)], "node string")
        return graph.walks(views.prerequisites(self.spark, self.base), start, depth)

    def locations(self, concept_id: str) -> DataFrame:
        """Places of a concept, five at most in a book."""
        return retrieval_queries.concept_locations(self.spark, self.base).where(F.col("concept_id") == concept_id)

    def concepts(self) -> DataFrame:
        """All concepts by name."""
        return graph_queries.all_concepts(self.spark, self.base)

    def books(self) -> DataFrame:
        """Titles of books."""
        return retrieval_queries.book_index(self.spark, self.base)

    def stats(self) -> DataFrame:
        """Sizes of the graph in one row."""
        return merge_queries.graph_stats(self.spark, self.base)

    def export(self) -> DataFrame:
        """All edges."""
        return retrieval_queries.graph_export(self.spark, self.base)
