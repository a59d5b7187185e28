"""Candidate generation: dictionary phrases in texts, scores, and alignment of local names with a registry."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions import text as T
from ..session import HOT_ROWS, cut, hot_keys, salted_lookup, spread, stored

# Least share of words of a sure name, and least ratio by which a rival can pass one of 0.93 with all it gets for sections and definitions.
SURE_WORDS, RIVAL_RATIO = 0.75, 0.86 - 1e-9


def _rolled(words: list[np.ndarray]) -> np.ndarray:
    """The hash of each gram from the hashes of its words in order."""
    g = words[0]
    for w in words[1:]:
        g = g * np.uint64(0x9E3779B97F4A7C15) + w
    return g


@F.pandas_udf(LongType())
def _gram(hashes: pd.Series) -> pd.Series:
    size = hashes.str.len().to_numpy(dtype=np.int64)
    flat, at, out = np.concatenate([np.empty(0, np.int64), *hashes]).view(np.uint64), np.cumsum(size) - size, np.empty(len(size), np.uint64)
    for n in np.unique(size):
        own = np.flatnonzero(size == n)
        out[own] = _rolled([flat[at[own] + i] for i in range(n)])
    return pd.Series(out.view(np.int64))


def _bits(index: DataFrame, power: int) -> np.ndarray:
    """A table of 2^power bits; those of the hashes ``_gram`` are set. It is aggregated before it is sent, so its size is all that the driver gets."""
    place = F.shiftrightunsigned("_gram", 64 - power)
    words = index.select(place.alias("_p")).select(F.shiftright("_p", 6).alias("w"), F.expr("shiftleft(1L, cast(_p & 63 AS int))").alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(1 << (power - 6), dtype=np.uint64)
    bits[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return bits


def _has(bits: np.ndarray, g: np.ndarray, power: int) -> np.ndarray:
    p = g >> np.uint64(64 - power)
    return (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1


def phrase_hits(texts: DataFrame, key: str, text: str, phrases: DataFrame, most_words: int = 6, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key``, ``phrase`` for every phrase of a dictionary that stands in a text, between borders of letters and digits.

    phrases: ``phrase`` (normalised, distinct). Texts are cut into runs of letters and digits; a phrase whose runs
    are n words long meets the texts' n-grams in an equi-join on the hash of the gram, never in a nested loop.
    Only gram lengths that the dictionary has are made, up to ``most_words``; longer phrases meet their first
    ``most_words`` words. A table of at most 2^27 bits, one for each gram's hash, rules out nearly all other grams where the text is
    read. The phrase itself, with its dots, plus and hash signs, is then verified in the text.
    """
    hashes = lambda c: F.transform(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    probe = phrases.withColumn("_h", hashes(F.col("phrase"))).where(F.size("_h") > 0).withColumn("_n", F.least(F.size("_h"), F.lit(most_words)))
    probe = cut(probe.select("phrase", "_n", _gram(F.slice("_h", 1, F.col("_n"))).alias("_gram")))
    # Phrases with one gram share a row of the index, which has one row per gram.
    index = cut(probe.groupBy("_gram").agg(F.collect_set("phrase").alias("_phrases")))
    lengths = sorted(r[0] for r in probe.select("_n").distinct().collect())
    normal = stored(texts.select(key, T.normalize_search(text).alias("_t")), "texts")
    if not lengths:
        return normal.select(key, F.lit("").alias("phrase")).limit(0)
    power = min(27, max(10, (64 * index.count()).bit_length()))
    known = texts.sparkSession.sparkContext.broadcast(_bits(index, power))

    def grams(batches):
        for batch in batches:
            at, flat = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64)
            flat, at = flat[at[0] : at[-1]], at - at[0]
            rows = np.repeat(np.arange(len(batch)), np.diff(at))
            left = at[rows + 1] - np.arange(len(rows))
            found = []
            for n in lengths:
                starts = np.flatnonzero(left >= n)
                g = _rolled([flat[starts + i] for i in range(n)])
                hit = _has(known.value, g, power)
                found.append(pd.DataFrame({"row": rows[starts[hit]], "gram": g[hit]}))
            each = pd.concat(found).drop_duplicates()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(each["row"].to_numpy())), pa.array(each["gram"].to_numpy().view(np.int64))], [key, "_gram"])

    kind = next(f.dataType.simpleString() for f in texts.schema if f.name == key)
    each = normal.select(key, hashes(F.col("_t")).alias("_h")).mapInArrow(grams, f"{key} {kind}, _gram bigint")
    # Grams move once: what the index does not have is gone before the rows are counted and looked up.
    kept = cut(each.join(index.select("_gram"), "_gram", "left_semi"))
    counts = cut(kept.groupBy("_gram").agg(F.count(F.lit(1)).alias("n")))
    found = salted_lookup(kept, index, "_gram", hot_keys(counts, "_gram", "n", hot_rows), "inner").select(key, F.explode("_phrases").alias("phrase")).distinct()
    checked = found.join(normal, key).where(T.has_phrase(F.col("phrase"), F.col("_t")))
    return checked.select(key, "phrase")


def content_scores(texts: DataFrame, key: str, text: str, registry: DataFrame) -> DataFrame:
    """``key``, ``concept_id``, ``score`` of concepts for texts by content alone.

    registry: ``concept_id``, ``names`` (array), ``short_definition``. A name in the text counts 1000 + 25 for each word
    of the longest; else two or more shared words of the definition count 200 + 20 each + 100 times their share.
    """
    names = registry.select("concept_id", F.explode("names").alias("n")).select("concept_id", T.normalize_name("n").alias("phrase")).where(F.length("phrase") >= 3).distinct()
    hits = phrase_hits(texts, key, text, names.select("phrase").distinct()).join(names, "phrase")
    exact = hits.groupBy(key, "concept_id").agg((F.lit(1000.0) + 25.0 * F.max(F.size(F.split("phrase", " ")))).alias("score"))
    said = texts.select(key, F.explode(T.content_words(text, T.CANDIDATE_STOPS, 3)).alias("w"))
    meant = registry.select("concept_id", T.content_words("short_definition", T.CANDIDATE_STOPS, 4).alias("ws")).where(F.size("ws") > 0)
    inverted = meant.select("concept_id", F.size("ws").alias("total"), F.explode("ws").alias("w"))
    shared = said.join(inverted, "w").groupBy(key, "concept_id").agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total")).where("n >= 2")
    loose = shared.join(exact, [key, "concept_id"], "left_anti").select(key, "concept_id", (F.lit(200.0) + 20.0 * F.col("n") + 100.0 * F.col("n") / F.col("total")).alias("score"))
    return exact.union(loose)


def named_concepts(texts: DataFrame, key: str, text: str, registry: DataFrame) -> DataFrame:
    """``key``, ``concept_id``, ``words`` (of the longest name that stands in the text) for every concept of a registry.

    registry: ``concept_id``, ``names`` (array). Names shorter than three characters are not sought.
    """
    names = stored(registry.select("concept_id", F.explode("names").alias("n")).select("concept_id", T.normalize_name("n").alias("phrase")).where(F.length("phrase") >= 3).distinct(), "names")
    hits = phrase_hits(texts, key, text, names.select("phrase").distinct()).join(names, "phrase")
    return hits.groupBy(key, "concept_id").agg(F.max(F.size(F.split("phrase", " "))).alias("words"))


def chapter_candidates(chunks: DataFrame, points: DataFrame, used: DataFrame, concepts: DataFrame, best: int) -> DataFrame:
    """``chunk_id``, ``concept_id``, ``score`` of the ``best`` concepts of each chunk within its chapter.

    chunks: ``chunk_id``, ``chapter_id``, ``primary_section``, ``sections``, ``text``; points, used: ``concept_id``, ``chapter_id``, ``section`` of points
    of knowledge and of other evidence; concepts: ``concept_id``, ``canonical_name``, ``chapter_id``, ``names``. A point in one of the chunk's
    sections counts 100, and 20 more for each that lies in its primary one; other evidence there 80; a name of the
    chapter's own concepts in the text 120. The greatest counts; ties fall to the greater name.
    """
    from .merge import top_per_key

    by_name = [F.desc_nulls_last("canonical_name"), "concept_id"]
    own = F.array_sort(F.array_distinct(F.array_compact(F.coalesce("sections", F.array().cast("array<string>")))))
    placed = chunks.select("chunk_id", "chapter_id", "primary_section", own.alias("_own")).withColumn("_place", F.to_json(F.struct("chapter_id", "primary_section", "_own")))
    # Chunks of the same sections get the same list, and what is not among the best of a section's points or uses is not among a list's best.
    places = placed.select("_place", "chapter_id", "primary_section", "_own").distinct()
    at = places.select("_place", "chapter_id", "primary_section", F.explode(F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.array("primary_section"))).alias("section"))
    titles = concepts.select("concept_id", "canonical_name")
    counted = points.groupBy("chapter_id", "section", "concept_id").agg(F.count(F.lit(1)).alias("n")).join(titles, "concept_id")
    firsts = lambda df, order, score, primary: top_per_key(df, ["chapter_id", "section"], order, best).select("chapter_id", "section", "concept_id", "canonical_name", score.cast("int").alias("score"), F.lit(primary).alias("_primary"))
    best_of = firsts(counted, [F.desc("n"), *by_name], 100 + 20 * F.col("n"), True).union(firsts(counted, by_name, F.lit(100), False)).union(firsts(used.distinct().join(titles, "concept_id"), by_name, F.lit(80), False))
    scored = at.join(best_of, ["chapter_id", "section"]).where(~F.col("_primary") | (F.col("section") == F.col("primary_section"))).groupBy("_place", "concept_id", "canonical_name").agg(F.max("score").alias("score"))
    item = F.struct("score", "canonical_name", "concept_id")
    lists = top_per_key(scored, ["_place"], [F.desc("score"), *by_name], best).groupBy("_place").agg(F.array_sort(F.collect_list(F.struct("place", item.alias("x")))).alias("_l")).select("_place", F.col("_l.x").alias("_listed"))
    chapters = concepts.select("concept_id", "canonical_name", F.col("chapter_id").alias("_chapter"))
    named = named_concepts(chunks, "chunk_id", "text", concepts).join(chapters, "concept_id").join(chunks.select("chunk_id", "chapter_id"), "chunk_id").where("_chapter = chapter_id")
    told = named.withColumn("score", F.lit(120)).groupBy("chunk_id").agg(F.collect_list(item).alias("_named"))
    # Both arrays meet where the chunk is: no chunk's candidates are rows before they are its best.
    both = placed.select("chunk_id", "_place").join(told, "chunk_id", "left").join(lists, "_place", "left")
    none = F.array().cast("array<struct<score:int,canonical_name:string,concept_id:string>>")
    both = both.select("chunk_id", F.coalesce("_named", none).alias("_named"), F.coalesce("_listed", none).alias("_listed"))
    high = F.transform(F.filter("_listed", lambda x: x["score"] >= 120), lambda x: x["concept_id"])
    new = F.filter("_named", lambda x: ~F.array_contains(high, x["concept_id"]))
    rest = F.filter("_listed", lambda x: (x["score"] >= 120) | ~F.array_contains(F.transform("_named", lambda y: y["concept_id"]), x["concept_id"]))
    order = lambda x, y: (
        F.when(x["score"] != y["score"], y["score"] - x["score"]).when(x["canonical_name"].isNull() != y["canonical_name"].isNull(), F.when(x["canonical_name"].isNull(), 1).otherwise(-1))
        .when(x["canonical_name"] > y["canonical_name"], -1).when(x["canonical_name"] < y["canonical_name"], 1).when(x["concept_id"] < y["concept_id"], -1).when(x["concept_id"] > y["concept_id"], 1).otherwise(0)
    )
    merged = F.when(F.size("_named") == 0, F.col("_listed")).otherwise(F.slice(F.array_sort(F.concat(new, rest), order), 1, best))
    return both.select("chunk_id", F.explode(merged).alias("x")).select("chunk_id", "x.concept_id", "x.score")


def _best_shared(registry: pd.DataFrame, texts: pd.DataFrame, best: int) -> pd.DataFrame:
    """The ``best`` + ``named`` concepts of each text by shared words of their definitions; ties fall by id."""
    registry = registry.sort_values("concept_id", ignore_index=True)
    each = registry["ws"].str.split(" ")
    total = each.str.len().to_numpy(dtype=np.int64)
    owner = np.repeat(np.arange(len(registry), dtype=np.int32), total)
    places = pd.Series(owner).groupby(np.array([w for ws in each for w in ws], dtype=object)).indices
    inverted = {w: owner[at] for w, at in places.items()}
    ids, rows = registry["concept_id"].to_numpy(), []
    for key, said, named in zip(texts["_key"], texts["ws"], texts["named"]):
        lists = [inverted[w] for w in said.split(" ") if w in inverted]
        if len(lists) < 2:
            continue
        n = np.bincount(np.concatenate(lists), minlength=len(ids))
        at = np.flatnonzero(n >= 2)
        score = np.round(200.0 + 20.0 * n[at] + 100.0 * n[at] / total[at], 6)
        most = best + int(named)
        if len(at) > most:
            least = np.partition(score, len(at) - most)[len(at) - most]
            above = np.flatnonzero(score > least)
            chosen = np.concatenate([above, np.flatnonzero(score == least)[: most - len(above)]])
            at, score = at[chosen], score[chosen]
        rows.append((np.full(len(at), key, dtype=object), ids[at], score))
    columns = [np.concatenate(c) for c in zip((np.empty(0, dtype=object), np.empty(0, dtype=object), np.empty(0)), *rows)]
    return pd.DataFrame(dict(zip(["_key", "concept_id", "score"], columns)))


def best_content(texts: DataFrame, key: str, text: str, registry: DataFrame, best: int, shard_concepts: int = 50_000, block_texts: int = 5_000) -> DataFrame:
    """The ``best`` concepts of each text by ``content_scores``, scores rounded to six places, ties by id.

    Every concept is scored, by each of its names and by its own definition. Definitions and texts share words in
    nearly all pairs, so pairs are never rows: each task counts the shared words of a shard of the registry and a
    block of texts, and gives a text's best and as many more as concepts are named in it, since these leave by their names.
    """
    from .merge import top_per_key

    exact = cut(named_concepts(texts, key, text, registry).select(key, "concept_id", F.round(F.lit(1000.0) + 25.0 * F.col("words"), 6).alias("score")))
    joined = lambda c, shortest: F.array_join(T.content_words(c, T.CANDIDATE_STOPS, shortest), " ")
    said = texts.select(F.col(key).alias("_key"), joined(text, 3).alias("ws")).where("ws <> ''")
    named = exact.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("named"))
    said = cut(said.join(named, "_key", "left").withColumn("named", F.coalesce("named", F.lit(0))))
    meant = cut(registry.select("concept_id", joined("short_definition", 4).alias("ws")).where("ws <> ''"))
    shards = max(1, -(-meant.count() // shard_concepts))
    blocks = max(2 * texts.sparkSession.sparkContext.defaultParallelism // shards, -(-said.count() // block_texts), 1)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = meant.select(F.pmod(F.xxhash64("concept_id"), F.lit(shards)).alias("_shard"), every(blocks).alias("_block"), "concept_id", "ws")
    right = said.select(every(shards).alias("_shard"), F.pmod(F.xxhash64("_key"), F.lit(blocks)).alias("_block"), "_key", "ws", "named")
    kinds = {f.name: f.dataType.simpleString() for f in [*texts.schema, *registry.schema]}

    def shared(concepts: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return _best_shared(concepts, block, best)

    loose = left.groupBy("_shard", "_block").cogroup(right.groupBy("_shard", "_block")).applyInPandas(shared, f"_key {kinds[key]}, concept_id {kinds['concept_id']}, score double").withColumnRenamed("_key", key)
    scores = exact.union(loose.join(exact, [key, "concept_id"], "left_anti").select(key, "concept_id", "score"))
    return top_per_key(scores, [key], [F.desc("score"), "concept_id"], best).drop("place")


def likely_names(local: DataFrame, names: DataFrame) -> DataFrame:
    """``local_id``, ``concept_id``, ``a``, ``b``: names of one chapter that share ``SURE_WORDS`` of their words, and whose lengths allow a ratio of 0.93.

    local: ``local_id``, ``chapter``, ``name`` (normalised, singular); names: the same with ``concept_id``. A name with that share has one of
    the local name's rarest words, as many as it may lack and one more, so pairs come from an equi-join on these and not from all names of a chapter.
    """
    each = names.select("concept_id", "chapter", F.col("name").alias("b"), F.explode(T.words_of(F.col("name"))).alias("w"))
    counts = each.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    said = local.select("local_id", "chapter", F.col("name").alias("a"), F.explode(T.words_of(F.col("name"))).alias("w")).join(counts, "w", "left")
    ranked = said.groupBy("local_id", "chapter", "a").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w"))).alias("_o"))
    some = F.size("_o") - F.ceil(F.lit(SURE_WORDS) * F.size("_o") - 1e-9).cast("int") + 1
    asked = ranked.select("local_id", "chapter", "a", F.explode(F.slice("_o", F.lit(1), some)).alias("_o")).select("local_id", "chapter", "a", "_o.w")
    pairs = asked.join(each, ["chapter", "w"]).where(T.can_reach("a", "b", 0.93)).select("local_id", "concept_id", "a", "b").distinct()
    return pairs.where(T.jaccard(T.words_of(F.col("a")), T.words_of(F.col("b"))) >= SURE_WORDS)


def align(local: DataFrame, registry: DataFrame) -> DataFrame:
    """``local_id``, ``concept_id``, ``method``, ``score`` for every local name.

    local: ``local_id``, ``name``, ``aliases``, ``section``, ``definition``, ``chapter``; registry: ``concept_id``, ``canonical_name``,
    ``aliases``, ``short_definition``, ``sections`` (array), ``chapter``. Exact keys come first; several hits are told apart
    by section, then by a gap of 0.25 in definitions; the rest is compared by strict string ratios within its
    chapter. What stays open is UNMAPPED.
    """
    local, registry = stored(local, "local"), stored(registry, "registry")
    all_names = lambda name: F.explode(F.concat(F.array(name), F.coalesce("aliases", F.array().cast("array<string>"))))
    # Names are normalised once each, not once a key or pair.
    plain = lambda df, key, name: stored(spread(df).select(key, "chapter", all_names(name).alias("n")).select(key, "chapter", T.normalize_name("n").alias("plain")).where("plain <> ''"), "names")
    mine, theirs = plain(local, "local_id", "name"), plain(registry, "concept_id", "canonical_name")
    keyed = lambda df, key: df.select(key, F.explode(F.array_distinct(F.array("plain", T.singular_words(F.col("plain"))))).alias("k")).distinct()
    hits = stored(keyed(mine, "local_id").join(keyed(theirs, "concept_id"), "k").select("local_id", "concept_id").distinct(), "hits")
    facts = registry.select("concept_id", "short_definition", "sections")
    # One hit stands as it is; only several are told apart by definitions.
    found = hits.groupBy("local_id").agg(F.count(F.lit(1)).alias("n"), F.min("concept_id").alias("concept_id"))
    single = found.where("n = 1").select("local_id", "concept_id", F.lit("EXACT_NAME_OR_ALIAS").alias("method"), F.lit(1.0).alias("score"))
    several = hits.join(found.where("n > 1").select("local_id"), "local_id", "left_semi")
    judged = several.join(local.select("local_id", "section", "definition"), "local_id").join(facts, "concept_id").select(
        "local_id", "concept_id", T.section_compatible(F.col("section"), F.col("sections")).cast("int").alias("s"), T.definition_overlap("definition", "short_definition").alias("d")
    )
    w = Window.partitionBy("local_id").orderBy(F.desc("s"), F.desc("d"), "concept_id")
    ranked = judged.select("*", F.row_number().over(w).alias("n"), F.lead("s").over(w).alias("s2"), F.lead("d").over(w).alias("d2")).where("n = 1")
    clear = (F.col("s") > F.col("s2")) | (F.col("d") - F.col("d2") >= 0.25)
    exact = single.union(ranked.select(
        "local_id", F.when(clear, F.col("concept_id")).alias("concept_id"), F.when(clear, "EXACT_DISAMBIGUATED").otherwise("AMBIGUOUS_EXACT").alias("method"),
        F.when(clear, 0.7 + 0.2 * F.col("s") + 0.1 * F.col("d")).otherwise(0.0).alias("score"),
    ))
    one = lambda df, key: df.select(key, "chapter", T.singular_words(F.col("plain")).alias("name")).distinct()
    left, names = stored(one(mine.join(hits.select("local_id"), "local_id", "left_anti"), "local_id"), "left"), one(theirs, "concept_id")
    # Only who has a name that is alike by its words and its letters can be mapped at all; all names of its chapter compete for it.
    alike = stored(likely_names(left, names).where(T.sequence_ratio_from(0.93)("a", "b") >= 0.93).select("local_id").distinct(), "alike")
    pairs = left.join(alike, "local_id", "left_semi").withColumnRenamed("name", "a").join(names.withColumnRenamed("name", "b"), "chapter").where(T.can_reach("a", "b", RIVAL_RATIO))
    rated = pairs.select("local_id", "concept_id", T.sequence_ratio_from(RIVAL_RATIO)("a", "b").alias("r"), T.jaccard(T.words_of(F.col("a")), T.words_of(F.col("b"))).alias("j")).where("r IS NOT NULL")
    best = rated.groupBy("local_id", "concept_id").agg(F.max(F.struct("r", "j")).alias("m")).join(local.select("local_id", "section", "definition"), "local_id").join(facts, "concept_id")
    bonus = 0.03 * T.section_compatible(F.col("section"), F.col("sections")).cast("int") + 0.04 * T.definition_overlap("definition", "short_definition")
    total = best.select("local_id", "concept_id", F.least(F.lit(1.0), F.col("m.r") + bonus).alias("t"), F.col("m.r").alias("r"), F.col("m.j").alias("j"))
    top = total.groupBy("local_id").agg(F.max(F.struct("t", "j", "r", "concept_id")).alias("x")).select("local_id", "x.*")
    sure = ((F.col("r") >= 0.965) & (F.col("j") >= SURE_WORDS)) | ((F.col("r") >= 0.93) & (F.col("j") >= 0.85) & (F.col("t") >= 0.96))
    fuzzy = top.where(sure).select("local_id", "concept_id", F.lit("HIGH_CONFIDENCE_FUZZY").alias("method"), F.round("t", 4).alias("score"))
    told = local.select("local_id").join(exact.union(fuzzy), "local_id", "left")
    return told.select("local_id", "concept_id", F.coalesce("method", F.lit("UNMAPPED")).alias("method"), F.coalesce("score", F.lit(0.0)).alias("score"))


def probes(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """``a``, ``b``, ``concept_id``, ``chunk_id``: of each pair the chunks of the end that fewer chunks name, with the other end to be sought in them.

    pairs: distinct ``a``, ``b``; named: distinct ``concept_id``, ``chunk_id``. A hub is in very many pairs and chunks; its chunks are never listed for each of its pairs.
    """
    counts = named.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n"))
    end = lambda x: counts.select(F.col("concept_id").alias(x), F.col("n").alias(f"_n{x}"))
    first = F.col("_na") <= F.col("_nb")
    rare = pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", F.when(first, F.col("a")).otherwise(F.col("b")).alias("_rare"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("_other"))
    return rare.join(named.withColumnRenamed("concept_id", "_rare"), "_rare").select("a", "b", F.col("_other").alias("concept_id"), "chunk_id")


def shared_chunks(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """``a``, ``b``, ``chunk_id``: the chunks that name both ends of a pair."""
    return probes(pairs, named).join(named, ["concept_id", "chunk_id"], "left_semi").select("a", "b", "chunk_id")


def near_duplicates(names: DataFrame, key: str, name: str, stops: list[str]) -> DataFrame:
    """``part``, ``whole`` - names of two or more words all of which another name has; by counting shared words."""
    w = names.select(F.col(key).alias("k"), T.content_words(name, stops, 1, True).alias("ws")).where(F.size("ws") >= 2)
    each = w.select("k", F.size("ws").alias("n"), F.explode("ws").alias("w"))
    both = each.select(F.col("k").alias("part"), "n", "w").join(each.select(F.col("k").alias("whole"), "w"), "w").where("part <> whole")
    return both.groupBy("part", "whole").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")).where("c = n").select("part", "whole")


def any_of(words: list[str], c: Column) -> Column:
    """Whether a text has one of some words."""
    return F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(c), w)), F.lit(False))
