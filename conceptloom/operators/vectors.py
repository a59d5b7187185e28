"""Vector operators: exact scores, top-k with filters, embedding tables, and all-pairs scoring in blocks."""

from __future__ import annotations

import hashlib
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column, strict: bool = True) -> Column:
    """V4: cosine in double precision within -1 and 1; 0 for a zero vector; an error for different lengths, or 0 if not strict."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    same = F.size(a) == F.size(b) if not strict else F.when(F.size(a) == F.size(b), F.lit(True)).otherwise(F.raise_error(F.lit("vectors of different length")).cast("boolean"))
    return F.when(same & (size > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / size))).otherwise(F.lit(0.0))


def scored(rows: DataFrame, query: list[float], column: str = "embedding", scale: str = "cosine") -> DataFrame:
    """Rows whose vector has the query's length and finite values, with ``score``; scale 'index' maps to 0..1."""
    q = F.array(*(F.lit(float(x)) for x in query))
    fine = (F.size(column) == len(query)) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Filters may be evaluated in any order, so vectors of another length must not raise here.
    c = cosine(F.col(column), q, strict=False)
    return rows.where(fine).withColumn("score", (c + 1) / 2 if scale == "index" else c)


def top_k(rows: DataFrame, query: list[float], k: int, key: str, where: Column | None = None, post_filter: bool = False, scale: str = "cosine") -> DataFrame:
    """V1, V2, V3: the ``k`` best rows by score, then key. A filter applies before the choice, or after it with ``post_filter``."""
    s = scored(rows if where is None or post_filter else rows.where(where), query, scale=scale)
    best = s.orderBy(F.desc("score"), key).limit(k)
    return best.where(where) if where is not None and post_filter else best


class Embedder(Protocol):
    """Texts to vectors; ``model_id`` and ``dim`` never differ within a table."""

    model_id: str
    dim: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    """An offline embedder: hashed character trigrams, unit length; blank texts give the zero vector."""

    def __init__(self, dim: int = 768):
        self.dim, self.model_id = dim, f"hash-trigram-{dim}"

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        cache: dict[str, tuple[int, int]] = {}
        for i, text in enumerate(texts):
            text = " ".join((text or "").lower().split())
            for k in range(max(0, len(text) - 2)):
                gram = text[k : k + 3]
                if gram not in cache:
                    h = int.from_bytes(hashlib.blake2b(gram.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                    cache[gram] = (h % self.dim, 1 if h >> 63 else -1)
                at, sign = cache[gram]
                out[i, at] += sign
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(size > 0, size, 1)


def embed_column(rows: DataFrame, text: Column, embedder: Embedder, column: str = "embedding") -> DataFrame:
    """V6, V7: a vector of each row's text and the id of its model."""

    @F.pandas_udf(K.ArrayType(K.FloatType()))
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series(list(embedder.embed([t or "" for t in texts])))

    return rows.withColumn(column, vector(text)).withColumn("model_id", F.lit(embedder.model_id))


def write_back(rows: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """V8: rows with the vectors of ``fresh`` (key, embedding, model_id) in place of their own, by key and not by name."""
    new = fresh.select(key, F.col("embedding").alias("_e"), F.col("model_id").alias("_m"))
    joined = rows.join(new, key, "left")
    return joined.withColumn("embedding", F.coalesce("_e", "embedding")).withColumn("model_id", F.coalesce("_m", "model_id")).select(rows.columns)


def vector_column(rows: DataFrame, wanted: str | None = None) -> str:
    """V9: the column that holds vectors: the one asked for, else the first array of floats; an error if there is none."""
    found = [f.name for f in rows.schema if isinstance(f.dataType, K.ArrayType) and isinstance(f.dataType.elementType, (K.FloatType, K.DoubleType))]
    if wanted in found:
        return wanted
    if not found or wanted:
        raise ValueError(f"no column of vectors{f' named {wanted}' if wanted else ''}")
    return found[0]


def one_model(rows: DataFrame) -> str | None:
    """The only model of a table of vectors; an error if there are several."""
    models = [r[0] for r in rows.where("embedding IS NOT NULL").select("model_id").distinct().limit(2).collect()]
    if len(models) > 1:
        raise ValueError("vectors of several models must not be compared")
    return models[0] if models else None


def block_pairs(rows: DataFrame, key: str, group: str, least: float, column: str = "embedding", block_rows: int = 2000) -> DataFrame:
    """``a`` < ``b``, ``score`` of rows of different ``group`` at least that similar, by products of blocks.

    Rows are cut into blocks by the hash of their key; each pair of blocks is one task that multiplies two
    matrices of about ``block_rows`` rows. Exact and quadratic by nature: for large tables use an index instead.
    """
    rows = rows.select(F.col(key).alias("k"), F.col(group).alias("g"), F.col(column).alias("v")).where("v IS NOT NULL")
    blocks = max(1, -(-rows.count() // block_rows))
    own = rows.withColumn("own", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
    # Each unordered pair of blocks once: a row goes to all pairs that hold its block.
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = own.withColumn("other", other).select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "k", "g", "v")

    def multiply(key_, part: pd.DataFrame) -> pd.DataFrame:
        i, j = key_
        left, right = part[part["own"] == i], part[part["own"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "score": []})
        x, y = (np.stack(p["v"].to_numpy()).astype(np.float64) for p in (left, right))
        x, y = (m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) > 0, n, 1) for m in (x, y))
        score = x @ y.T
        p, q = np.nonzero(score >= least)
        a, b = left["k"].to_numpy()[p], right["k"].to_numpy()[q]
        fine = (left["g"].to_numpy()[p] != right["g"].to_numpy()[q]) & ((a < b) if i == j else True)
        return pd.DataFrame({"a": [min(s, t) for s, t in zip(a[fine], b[fine])], "b": [max(s, t) for s, t in zip(a[fine], b[fine])], "score": score[p, q][fine]})

    kind = rows.schema["k"].dataType.simpleString()
    return placed.groupBy("i", "j").applyInPandas(multiply, f"a {kind}, b {kind}, score double")
