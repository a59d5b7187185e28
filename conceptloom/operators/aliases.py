"""Aliases stated in texts, folding of alias records, and canonical spellings of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Phrases by which a text states that two names mean one thing.
STATEMENTS = [
    r"([A-Z][A-Za-z\-\s]{2,60}?),?\s+also\s+known\s+as\s+(?:the\s+)?([A-Z][A-Za-z\-\s]{2,60})",
    r"([A-Z][A-Za-z\-\s]{2,60}?),?\s+also\s+called\s+(?:the\s+)?([A-Z][A-Za-z\-\s]{2,60})",
    r"([A-Z][A-Za-z\-\s]{2,60}?)\s*\((?:aka|a\.k\.a\.|also\s+known\s+as|also\s+called)\s+([A-Z][A-Za-z\-\s]{2,60})\)",
    r"([A-Z][A-Za-z\-\s]{2,60}?),\s+or\s+([A-Z][A-Za-z\-\s]{2,60})",
    r"([A-Z][A-Za-z\-]{2,40}(?:\s+[A-Z][A-Za-z\-]{2,40}){0,3})\s+\(([A-Z][A-Za-z]{1,20})\)",
]


def acronym(c: Column) -> Column:
    """Whether a name is all capitals and digits, twelve at most."""
    bare = F.regexp_replace(c, "[^A-Za-z0-9]", "")
    return (F.length(bare).between(1, 12)) & (F.upper(bare) == bare)


def stated_aliases(texts: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """``canonical``, ``alias``, ``seen_in`` (the first text) for stated pairs of which both names are known.

    names: ``name``, ``core`` (boolean). A core name is canonical before others, a full name before an acronym, the longer
    before the shorter, the first in order among equals. Null texts state nothing.
    """
    flat = texts.select(key, F.col(text).alias("_t")).where("_t IS NOT NULL")
    both = None
    for pattern in STATEMENTS:
        zipped = F.arrays_zip(F.regexp_extract_all("_t", F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all("_t", F.lit(pattern), F.lit(2)).alias("b"))
        part = flat.select(key, F.explode(zipped).alias("p")).select(key, F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        both = part if both is None else both.union(part)
    plain = lambda c: F.lower(T.squeeze(F.col(c)))
    known = names.select(plain("name").alias("k"), "name", "core").groupBy("k").agg(F.min("name").alias("name"), F.bool_or("core").alias("core"))
    side = lambda x: known.select(F.col("k").alias(f"k{x}"), F.col("name").alias(f"n{x}"), F.col("core").alias(f"c{x}"))
    found = both.select(key, plain("a").alias("ka"), plain("b").alias("kb")).where("ka <> kb").join(side("a"), "ka").join(side("b"), "kb")
    rank = lambda x: F.struct(F.col(f"c{x}"), ~acronym(F.col(f"n{x}")), F.length(f"n{x}"))
    first = (rank("a") > rank("b")) | ((rank("a") == rank("b")) & (F.col("na") < F.col("nb")))
    pairs = found.select(F.when(first, F.col("na")).otherwise(F.col("nb")).alias("canonical"), F.when(first, F.col("nb")).otherwise(F.col("na")).alias("alias"), key)
    return pairs.groupBy("canonical", "alias").agg(F.min(key).alias("seen_in"))


def fold(concepts: DataFrame, aliases: DataFrame) -> DataFrame:
    """``name``, ``aliases``, ``definition`` with alias records folded into their canonical ones.

    concepts: ``name``, ``aliases``, ``definition``; aliases: ``canonical``, ``alias``, one row per alias.
    """
    moved = concepts.join(aliases.select(F.col("alias").alias("name"), "canonical"), "name", "left").withColumn("target", F.coalesce("canonical", "name"))
    extra = F.when(F.col("canonical").isNotNull(), F.array("name")).otherwise(F.array().cast("array<string>"))
    own = F.concat(F.coalesce("aliases", F.array().cast("array<string>")), extra)
    out = moved.groupBy("target").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(own)))).alias("aliases"), F.max_by("definition", F.struct(F.length("definition"), "name")).alias("definition"))
    return out.select(F.col("target").alias("name"), F.filter("aliases", lambda a: a != F.col("target")).alias("aliases"), "definition")


def canonical_names(names: DataFrame, name: str, exact: DataFrame) -> DataFrame:
    """Adds ``canonical``: a listed spelling, or the name's words written together with capitals.

    exact: ``name``, ``canonical`` - the maps of a deployment, as data.
    """
    known = exact.select(F.col("name").alias(name), F.col("canonical").alias("_c")).dropDuplicates([name])
    words = F.filter(F.split(F.regexp_replace(T.split_pascal(F.col(name)), "[^A-Za-z0-9]+", " "), " "), lambda w: w != "")
    pascal = F.array_join(F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))), "")
    return names.join(known, name, "left").withColumn("canonical", F.coalesce("_c", pascal)).drop("_c")
