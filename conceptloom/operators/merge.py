"""Idempotent upserts by key, and aggregations that consolidate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_distinct(value: Column, order: Column) -> Column:
    """Distinct values of a group in the order of their first arrival; nulls are left out."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.array_distinct(F.transform(rows, lambda r: r["v"]))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


#: How a column of an existing row meets the incoming value; ``o`` and ``n`` are the two values.
RULES = {
    "overwrite": lambda o, n: n,
    "keep": lambda o, n: o,
    "coalesce_old": lambda o, n: F.coalesce(o, n),
    "coalesce_new": lambda o, n: F.coalesce(n, o),
    "nonempty_old": lambda o, n: F.when(_blank(o), n).otherwise(o),
    "longer": lambda o, n: F.when(F.length(F.coalesce(n, F.lit(""))) > F.length(F.coalesce(o, F.lit(""))), n).otherwise(o),
    "maximum": lambda o, n: F.greatest(o, n),
    "minimum": lambda o, n: F.least(o, n),
    "add": lambda o, n: F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0)),
    "any": lambda o, n: F.coalesce(o, F.lit(False)) | F.coalesce(n, F.lit(False)),
    "append": lambda o, n: F.array_distinct(F.concat(F.coalesce(o, F.array().cast("array<string>")), F.coalesce(n, F.array().cast("array<string>")))),
}


def merge_upsert(current: DataFrame, incoming: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """The current rows with incoming ones merged in, column by column.

    Both sides have one row per key (``first_per_key`` and the aggregations here see to that); a null key is
    a key of its own. Columns without a rule are overwritten. Applying the same batch twice changes nothing more,
    but for 'add', which counts applications.
    """
    columns = [c for c in current.columns if c not in keys]
    old = current.select(*keys, F.struct(*columns).alias("_old"), F.lit(True).alias("_had"))
    new = incoming.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.struct(*(F.col(c) if c in incoming.columns else F.lit(None).cast(current.schema[c].dataType).alias(c) for c in columns)).alias("_new"), F.lit(True).alias("_came"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    both = old.join(new, on, "full")

    def merged(c: str) -> Column:
        o, n = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        return F.when(F.col("_had").isNull(), n).when(F.col("_came").isNull(), o).otherwise(RULES[rules.get(c, "overwrite")](o, n)).alias(c)

    return both.select(*(F.when(F.col("_had").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys), *map(merged, columns)).select(current.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order that ties cannot change."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def top_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= n)


def arbitrate(edges: DataFrame) -> DataFrame:
    """One edge for each pair of nodes, whatever its direction: the most confident, the earliest among equals.

    edges: ``source``, ``target``, ``confidence``, ``arrival``. Edges to themselves are dropped.
    """
    kept = edges.where("source <> target")
    best = F.max_by(F.struct("source", "target", "confidence", "arrival"), F.struct("confidence", -F.col("arrival")))
    return kept.groupBy(F.least("source", "target").alias("_a"), F.greatest("source", "target").alias("_b")).agg(best.alias("e")).select("e.*")


def aggregate_relations(edges: DataFrame, symmetric: list[str]) -> DataFrame:
    """A2: one row per source, target and relation; the ends of symmetric relations are ordered first.

    edges: ``source``, ``target``, ``relation``, ``confidence``, ``evidence`` (array of chunk_id, quote). Evidence counts
    once per chunk and normalised quote; the mean covers all rows, also those whose evidence is repeated.
    """
    from ..functions.text import normalize_text

    flip = F.col("relation").isin(symmetric) & (F.col("source") > F.col("target"))
    own = edges.withColumn("_s", F.when(flip, F.col("target")).otherwise(F.col("source"))).withColumn("_t", F.when(flip, F.col("source")).otherwise(F.col("target")))
    keys = [F.col("_s").alias("source"), F.col("_t").alias("target"), F.col("relation")]
    numbers = own.groupBy(*keys).agg(F.round(F.max("confidence"), 4).alias("confidence_max"), F.round(F.avg("confidence"), 4).alias("confidence_mean"), F.count(F.lit(1)).alias("n_rows"))
    quotes = own.select(*keys, F.explode("evidence").alias("e")).select("source", "target", "relation", F.col("e.chunk_id").alias("chunk_id"), normalize_text("e.quote").alias("q")).distinct()
    proof = quotes.groupBy("source", "target", "relation").agg(F.count(F.lit(1)).alias("evidence_count"), F.array_join(F.array_sort(F.collect_set("chunk_id")), "|").alias("source_chunks"))
    return numbers.join(proof, ["source", "target", "relation"], "left").na.fill({"evidence_count": 0, "source_chunks": ""})


def dedup_concepts(rows: DataFrame, key: Column) -> DataFrame:
    """One record per key: longest definition, all aliases but the own name, flags joined.

    rows: ``name``, ``definition``, ``aliases``, ``category``, ``flag``, ``confidence``, ``arrival``.
    """
    keyed = rows.withColumn("_k", key)
    own = keyed.groupBy("_k").agg(
        F.min_by("name", "arrival").alias("name"),
        F.max_by("definition", F.struct(F.length("definition"), -F.col("arrival"))).alias("definition"),
        F.min_by("category", F.struct(F.col("category").isNull(), F.col("arrival"))).alias("category"),
        F.bool_or("flag").alias("flag"),
        F.max("confidence").alias("confidence"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"),
    )
    return own.withColumn("aliases", F.filter("aliases", lambda a: a != F.col("name"))).withColumnRenamed("_k", "concept_key")
