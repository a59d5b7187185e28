"""Queries on text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import table
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()


@query(f"SELECT doc_id, sha256({S.normal_text('text')}) AS normal_hash FROM documents")
def normalize_text(spark: SparkSession, base: str) -> DataFrame:
    """T1 over all documents."""
    return table(spark, base, "documents").select("doc_id", F.sha2(T.normalize_text("text"), 256).alias("normal_hash"))


@query()
def normalize_text_compat(spark: SparkSession, base: str) -> DataFrame:
    """T1 with compatibility normalisation, which SQL lacks."""
    return table(spark, base, "documents").select("doc_id", F.sha2(T.normalize_text("text", True), 256).alias("normal_hash"))


@query(f"SELECT doc_id, sha256({S.search('text')}) AS search_hash FROM documents")
def normalize_search(spark: SparkSession, base: str) -> DataFrame:
    """T2 over all documents."""
    return table(spark, base, "documents").select("doc_id", F.sha2(T.normalize_search("text"), 256).alias("search_hash"))


@query(V.sql("g_concept") + f"SELECT concept_id, {S.name('canonical_name')} AS plain, {S.name('canonical_name', True)} AS singular FROM g_concept")
def normalize_name(spark: SparkSession, base: str) -> DataFrame:
    """T3, T4 over concept names."""
    return V.concepts(spark, base).select("concept_id", T.normalize_name("canonical_name").alias("plain"), T.normalize_name("canonical_name", True).alias("singular"))


@query(f"SELECT DISTINCT w AS token, {S.singular('w')} AS singular FROM (SELECT unnest(string_split({S.search('text')}, ' ')) AS w FROM documents) WHERE w <> ''")
def singularize(spark: SparkSession, base: str) -> DataFrame:
    """T4 over the distinct words of all documents."""
    words = table(spark, base, "documents").select(F.explode(F.split(T.normalize_search("text"), " ")).alias("token")).where("token <> ''").distinct()
    return words.select("token", T.singular(F.col("token")).alias("singular"))


@query(
    V.sql("g_concept") + f""", n AS (SELECT concept_id, unnest(list_concat([canonical_name], coalesce(aliases, []))) AS term FROM g_concept),
k AS (SELECT concept_id, unnest([{S.name('term')}, {S.name('term', True)}]) AS name_key FROM n)
SELECT DISTINCT concept_id, name_key FROM k WHERE name_key <> ''"""
)
def name_keys(spark: SparkSession, base: str) -> DataFrame:
    """Every key under which a concept is found."""
    terms = V.concepts(spark, base).select("concept_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term"))
    return terms.select("concept_id", F.explode(T.name_keys("term")).alias("name_key")).distinct()


_ENDS = "g_relation r JOIN g_concept a ON a.concept_id = r.source_concept_id JOIN g_concept b ON b.concept_id = r.target_concept_id"


def _ends(spark: SparkSession, base: str) -> DataFrame:
    c = V.concepts(spark, base)
    side = lambda x: c.select(*(F.col(n).alias(f"{x}_{n}") for n in ("concept_id", "canonical_name", "aliases", "short_definition", "broader_concept_id")))
    r = V.relations(spark, base)
    return r.join(side("a"), r.source_concept_id == F.col("a_concept_id")).join(side("b"), r.target_concept_id == F.col("b_concept_id"))


@query(V.sql("g_concept", "g_relation") + f"SELECT relation_id, round({S.jaccard(S.words(S.name('a.canonical_name', True)), S.words(S.name('b.canonical_name', True)))}, 6) AS similarity FROM {_ENDS}")
def token_jaccard_names(spark: SparkSession, base: str) -> DataFrame:
    """T9 between the names at the ends of every relation."""
    return _ends(spark, base).select("relation_id", F.round(T.token_jaccard("a_canonical_name", "b_canonical_name"), 6).alias("similarity"))


@query(V.sql("g_concept", "g_relation") + f"SELECT relation_id, round({S.jaccard(S.content('a.short_definition', T.DEFINITION_STOPS, 3), S.content('b.short_definition', T.DEFINITION_STOPS, 3))}, 6) AS overlap FROM {_ENDS}")
def definition_overlap(spark: SparkSession, base: str) -> DataFrame:
    """T10 between the definitions at the ends of every relation."""
    return _ends(spark, base).select("relation_id", F.round(T.definition_overlap("a_short_definition", "b_short_definition"), 6).alias("overlap"))


@query(
    V.sql("g_chunk") + """SELECT c.chunk_id, count(DISTINCT o.chunk_id) AS compatible FROM g_chunk c JOIN g_chunk o ON o.chapter_id = c.chapter_id AND o.chunk_id <> c.chunk_id
AND len(list_filter(o.sections, lambda s: s = trim(c.primary_section) OR starts_with(s, trim(c.primary_section) || '.') OR starts_with(trim(c.primary_section), s || '.'))) > 0
WHERE trim(coalesce(c.primary_section, '')) <> '' GROUP BY c.chunk_id"""
)
def section_compat(spark: SparkSession, base: str) -> DataFrame:
    """Chunks of a chapter with compatible sections, joined on all dotted prefixes instead of a nested loop."""
    c = V.chunks(spark, base).select("chunk_id", "chapter_id", F.trim("primary_section").alias("section"), "sections")

    def prefixes(s):
        parts = F.split(s, "\\.")
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))

    left = c.where("coalesce(section, '') <> ''").select("chunk_id", "chapter_id", "section")
    other = c.select(F.col("chunk_id").alias("o"), "chapter_id", F.explode("sections").alias("s"))
    # Equal or inside: the other's prefixes hold the section. Around: the section's proper prefixes hold the other.
    inside = left.join(other.select("o", "chapter_id", F.explode(prefixes(F.col("s"))).alias("section")), ["chapter_id", "section"])
    around = left.select("chunk_id", "chapter_id", F.explode(prefixes(F.col("section"))).alias("s")).join(other, ["chapter_id", "s"])
    pairs = inside.select("chunk_id", "o").union(around.select("chunk_id", "o")).where("chunk_id <> o").distinct()
    return pairs.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("compatible"))


@query(V.sql("g_chunk", "g_mention") + f"SELECT mention_id, {S.quote_in('quote', 'text')} AS found FROM g_mention JOIN g_chunk USING (chunk_id)")
def quote_in_chunk(spark: SparkSession, base: str) -> DataFrame:
    """Whether each mention's quote stands in its chunk."""
    k = V.chunks(spark, base, "text").select("chunk_id", T.normalize_text("text").alias("t"))
    both = V.mentions(spark, base, "quote").select("mention_id", "chunk_id", T.normalize_text("quote").alias("q")).join(k, "chunk_id")
    return both.select("mention_id", T.quote_in_normal(F.col("q"), F.col("t")).alias("found"))


@query(f"SELECT mention_id, round({S.clamp('confidence', 0.5)}, 6) AS clamped, count(*) AS n FROM mentions GROUP BY ALL")
def clamp_confidence(spark: SparkSession, base: str) -> DataFrame:
    """T8 over all deliveries of mentions."""
    return table(spark, base, "mentions").select("mention_id", F.round(T.clamp(F.col("confidence"), 0.5), 6).alias("clamped")).groupBy("mention_id", "clamped").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH s AS (SELECT DISTINCT trim(primary_section) AS section FROM section_chunks WHERE primary_section IS NOT NULL),
k AS (SELECT section, CASE WHEN len(list_filter(string_split(section, '.'), lambda p: NOT regexp_full_match(p, '[0-9]{1,9}'))) > 0 THEN [9999] ELSE list_transform(string_split(section, '.'), lambda p: p::INT) END AS key FROM s)
SELECT section, row_number() OVER (ORDER BY key, section) AS place FROM k"""
)
def natural_section_sort(spark: SparkSession, base: str) -> DataFrame:
    """Sections in natural order."""
    from pyspark.sql import Window

    s = table(spark, base, "section_chunks").where("primary_section IS NOT NULL").select(F.trim("primary_section").alias("section")).distinct()
    # Sections of a curriculum are few and known beforehand; the place is global, so the order has one task.
    return s.select("section", F.row_number().over(Window.orderBy(T.section_key(F.col("section")), "section")).alias("place"))


@query(
    V.sql("g_concept") + """, t AS (SELECT DISTINCT unnest(list_concat([canonical_name, name, name_zh], coalesce(aliases, []))) AS term FROM g_concept)
SELECT term, regexp_full_match(term, '[A-Z][A-Z0-9/-]{1,9}') AS acronym, regexp_matches(term, '[\\x{4e00}-\\x{9fff}]') AS cjk, regexp_full_match(term, '([A-Z][a-z0-9]+){2,}') AS pascal FROM t WHERE term IS NOT NULL"""
)
def name_predicates(spark: SparkSession, base: str) -> DataFrame:
    """Acronyms, Chinese terms and names written together."""
    c = V.concepts(spark, base)
    t = c.select(F.explode(F.concat(F.array("canonical_name", "name", "name_zh"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term")).where("term IS NOT NULL").distinct()
    return t.select("term", F.col("term").rlike("^[A-Z][A-Z0-9/-]{1,9}$").alias("acronym"), F.col("term").rlike("[\\u4e00-\\u9fff]").alias("cjk"), F.col("term").rlike("^([A-Z][a-z0-9]+){2,}$").alias("pascal"))


@query("WITH q AS (SELECT doc_id, coalesce(text, '') AS t FROM documents) SELECT doc_id, " + ", ".join(f"{S.cue('t', k)} AS {k}" for k in T.CUES) + " FROM q")
def cue_predicates(spark: SparkSession, base: str) -> DataFrame:
    """Families of cue words in every document."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, base, "documents").select("doc_id", *(T.cue(t, k).alias(k) for k in T.CUES))


@query(V.sql("g_concept") + f"SELECT {S.collapsed('canonical_name')} AS collapsed, replace(lower(trim(canonical_name)), ' ', '') AS spaceless, count(*) AS n FROM g_concept GROUP BY ALL")
def collapsed_keys(spark: SparkSession, base: str) -> DataFrame:
    """Keys of names, counted."""
    c = V.concepts(spark, base)
    return c.groupBy(T.collapsed_key(F.col("canonical_name")).alias("collapsed"), T.spaceless_key(F.col("canonical_name")).alias("spaceless")).agg(F.count(F.lit(1)).alias("n"))


@query(V.sql("g_chunk") + f"SELECT chunk_id, sha256({S.clean_chunk('text')}) AS clean_hash FROM g_chunk")
def clean_text(spark: SparkSession, base: str) -> DataFrame:
    """H7 over all chunks."""
    return V.chunks(spark, base).select("chunk_id", F.sha2(T.clean_chunk("text"), 256).alias("clean_hash"))


@query(
    V.sql("g_chunk") + f""", b AS (SELECT chunk_id, regexp_replace(coalesce(text, ''), '^[{S.SPACES}]+', '') AS t, right({S.squeeze("coalesce(text, '')")}, 180) AS tail FROM g_chunk)
SELECT chunk_id, regexp_matches(t, '^([,.;:)]|(?i)(is|are|was|were|and|or|but|which|that)\\b)') AS damaged,
tail <> '' AND NOT regexp_matches(tail, '[.!?;:)}}\\]]["'']?$') AND regexp_matches(tail, '(?i)\\b(a|an|the|and|or|but|to|of|in|on|for|with|from|that|which|whose|when|where)$') AS incomplete FROM b"""
)
def fragment_flags(spark: SparkSession, base: str) -> DataFrame:
    """Chunks with a damaged beginning or a cut end."""
    t = F.coalesce("text", F.lit(""))
    return V.chunks(spark, base).select("chunk_id", T.damaged_start(t).alias("damaged"), T.incomplete_end(t).alias("incomplete"))


@query(
    V.sql("g_chunk") + """, f AS (SELECT chunk_id, regexp_matches(coalesce(text, ''), '(?m)^[ \\t]*[A-Z][A-Z ]{6,}[ \\t]*$') AS head, regexp_matches(coalesce(text, ''), '(?i)\\bIN\\s+PRACTICE\\b') AS side,
regexp_matches(coalesce(text, ''), '\\b(DWORD|SIZE\\s+\\d+|char\\s*\\*|\\w+\\s*\\[\\s*\\d+\\s*\\])') AS code FROM g_chunk)
SELECT chunk_id, array_to_string(list_filter([CASE WHEN head THEN 'sidebar_or_running_head' END, CASE WHEN side THEN 'sidebar_contamination' END, CASE WHEN code THEN 'code_fragment_contamination' END, CASE WHEN side AND code THEN 'cross_section_or_sidebar_mixed_content' END], lambda x: x IS NOT NULL), '|') AS flags FROM f"""
)
def contamination_flags(spark: SparkSession, base: str) -> DataFrame:
    """T28 over all chunks."""
    return V.chunks(spark, base).select("chunk_id", F.array_join(T.contamination(F.coalesce("text", F.lit(""))), "|").alias("flags"))


@query()
def layout_flags(spark: SparkSession, base: str) -> DataFrame:
    """Label runs removed, label fragments and end-matter headings."""
    t = F.coalesce("text", F.lit(""))
    heading = F.exists(F.split(t, "\\n"), T.end_matter)
    return V.chunks(spark, base).select("chunk_id", (F.length(t) - F.length(T.strip_labels(t))).alias("removed"), T.label_fragment(t).alias("label_fragment"), heading.alias("end_matter"), F.sha2(T.trim_fragment(t), 256).alias("trimmed_hash"))


_TERMS = "list_concat([c.canonical_name], coalesce(c.aliases, []))"


@query(
    V.sql("g_concept", "g_mention") + f""", n AS (
  SELECT m.mention_id, m.evidence_type, {S.search('m.quote')} AS q, {S.words(S.name('m.quote', True))} AS qw, {_TERMS} AS names,
    {S.jaccard(S.content('m.quote', T.DEFINITION_STOPS, 3), S.content('c.short_definition', T.DEFINITION_STOPS, 3))} AS overlap
  FROM g_mention m JOIN g_concept c USING (concept_id)
), w AS (
  SELECT *, len(list_filter(list_transform(names, lambda x: {S.name('x')}), lambda k: k <> '' AND contains(' ' || regexp_replace(q, '[^a-z0-9]', ' ', 'g') || ' ', ' ' || regexp_replace(k, '[^a-z0-9]', ' ', 'g') || ' '))) > 0 AS named,
    coalesce(list_max(list_transform(list_transform(names, lambda x: list_filter({S.words(S.name('x', True))}, lambda y: length(y) > 2 AND y NOT IN ({", ".join(f"'{s}'" for s in T.ANCHOR_STOPS)}))),
      lambda ws: CASE WHEN len(ws) >= 2 AND len(list_intersect(ws, qw)) >= 2 THEN len(list_intersect(ws, qw))::DOUBLE / len(ws) ELSE 0.0 END)), 0.0) AS coverage FROM n
)
SELECT mention_id, CASE WHEN named THEN 'name_or_alias_in_quote' WHEN coverage >= 0.67 THEN 'distinctive_name_tokens_in_quote' WHEN evidence_type = 'definition' AND overlap >= 0.18 THEN 'definition_overlap' END AS anchor,
round(CASE WHEN named THEN 1.0 WHEN coverage >= 0.67 THEN coverage ELSE overlap END, 6) AS score FROM w"""
)
def anchor_scores(spark: SparkSession, base: str) -> DataFrame:
    """What ties each mention's quote to its concept."""
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    c = V.concepts(spark, base).select("concept_id", T.anchor_terms(names, "short_definition").alias("terms"))
    both = V.mentions(spark, base, "mention_id", "concept_id", "quote", "evidence_type").select("mention_id", "concept_id", "quote", "evidence_type").join(c, "concept_id")
    return T.anchored(both, "terms", "quote", "evidence_type").select("mention_id", "anchor", F.round("score", 6).alias("score"))


@query("""SELECT event_id, try_cast(json_extract_string(regexp_extract(x, '(?s)(\\{.*\\})', 1), '$.k') AS INT) AS k FROM (SELECT event_id, 'Answer: ' || chr(96) || props || chr(96) || ' done' AS x FROM events)""")
def json_extract_decisions(spark: SparkSession, base: str) -> DataFrame:
    """The object in a model's answer."""
    answer = F.concat(F.lit("Answer: `"), "props", F.lit("` done"))
    return table(spark, base, "events").select("event_id", F.get_json_object(T.json_object(answer), "$.k").cast("int").alias("k"))


@query(
    """WITH n AS (SELECT p_partkey, p_name || ' ' || ['Service', 'Mechanism, kernel side', 'Strategy', 'Model', 'table'][(p_partkey % 5) + 1] AS name FROM part), v AS (
  SELECT p_partkey, list_filter([""" + ", ".join(f"CASE WHEN ends_with(name, '{s}') THEN trim(left(name, length(name) - {len(s)})) END" for s in T.VARIANT_SUFFIXES)
    + ", " + ", ".join(f"CASE WHEN starts_with(name, '{p}') THEN trim(substr(name, {len(p) + 1})) END" for p in T.VARIANT_PREFIXES)
    + ", CASE WHEN contains(name, ',') THEN trim(string_split(name, ',')[1]) END], lambda v: v IS NOT NULL AND length(v) >= 3 AND lower(v) NOT IN (" + ", ".join(f"'{g}'" for g in T.GENERIC_VARIANTS) + ") AND (contains(v, ' ') OR length(v) >= 7)) AS vs FROM n)"
    + " SELECT p_partkey, array_to_string(list_sort(list_distinct(vs)), '|') AS variants FROM v"
)
def auto_variants(spark: SparkSession, base: str) -> DataFrame:
    """T24 over part names with known endings."""
    ending = F.element_at(F.array(*map(F.lit, ["Service", "Mechanism, kernel side", "Strategy", "Model", "table"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, base, "part").select("p_partkey", F.array_join(T.auto_variants(F.concat_ws(" ", "p_name", ending)), "|").alias("variants"))


def _generality_sql(c: str) -> str:
    cases = []
    for score, words in T.GENERALITY:
        for w in words.split():
            cases.append(f"WHEN ends_with({c}, '{w}') THEN {score}" if w.startswith("_") else f"WHEN {c} = '{w}' OR contains({c}, '_{w}') OR contains({c}, '{w}_') THEN {score}")
    return f"CASE {' '.join(cases)} WHEN regexp_matches({c}, '{'|'.join(T.GENERAL_ANYWHERE)}') THEN 7 ELSE 1 END"


@query(f"WITH t AS (SELECT DISTINCT lower(replace(split_part(name, ' ', 1) || '_' || name, ' ', '_')) AS kind FROM (SELECT p_name AS name FROM part UNION SELECT regexp_replace(canonical_name, '^[^ ]+ ', '') FROM concepts WHERE canonical_name IS NOT NULL)) SELECT kind, {_generality_sql('kind')} AS generality FROM t")
def type_generality(spark: SparkSession, base: str) -> DataFrame:
    """T36 over kinds made of names."""
    names = table(spark, base, "part").select(F.col("p_name").alias("name")).union(table(spark, base, "concepts").where("canonical_name IS NOT NULL").select(F.regexp_replace("canonical_name", "^[^ ]+ ", "")))
    kinds = names.select(F.lower(F.replace(F.concat_ws("_", F.substring_index("name", " ", 1), "name"), F.lit(" "), F.lit("_"))).alias("kind")).distinct()
    return kinds.select("kind", T.generality(F.col("kind")).alias("generality"))


@query("""WITH p AS (SELECT doc_id, text, list_min(list_filter([position('deadlock' IN lower(text)), position('journal' IN lower(text)), position('queue' IN lower(text))], lambda x: x > 0)) AS first FROM documents)
SELECT doc_id, sha256(substr(text, greatest(coalesce(first, 1) - 180, 1), 900)) AS snippet_hash FROM p""")
def snippets(spark: SparkSession, base: str) -> DataFrame:
    """A window around the earliest of three terms."""
    terms = F.array(F.lit("deadlock"), F.lit("journal"), F.lit("queue"))
    return table(spark, base, "documents").select("doc_id", F.sha2(T.snippet(F.col("text"), terms), 256).alias("snippet_hash"))


@query(V.sql("g_relation") + "SELECT relation_id, 'relation:' || left(sha1(source_concept_id || '|' || relation || '|' || target_concept_id), 12) AS item_id FROM g_relation WHERE relation IS NOT NULL")
def stable_ids(spark: SparkSession, base: str) -> DataFrame:
    """T40 over relations."""
    r = V.relations(spark, base).where("relation IS NOT NULL")
    return r.select("relation_id", T.stable_id(F.lit("relation"), F.concat_ws("|", "source_concept_id", "relation", "target_concept_id")).alias("item_id"))


@query(V.sql("g_chunk") + "SELECT chunk_id, sha256('v1' || chr(10) || 'all' || chr(10) || coalesce(text, '') || chr(10) || coalesce(chapter_id, '')) AS fingerprint FROM g_chunk")
def fingerprints(spark: SparkSession, base: str) -> DataFrame:
    """T43, H14; the scope is part of the key."""
    return V.chunks(spark, base).select("chunk_id", T.fingerprint(F.lit("v1"), F.lit("all"), F.col("text"), F.col("chapter_id")).alias("fingerprint"))


@query(
    V.sql("g_concept", "g_relation") + f""", q AS (SELECT relation_id, relation, lower(a.canonical_name) AS s, lower(b.canonical_name) AS t, unnest(['A ' || b.canonical_name || ' is a kind of ' || a.canonical_name || '.', a.canonical_name || ' is part of ' || b.canonical_name, a.canonical_name || ' leads to ' || b.canonical_name]) AS quote FROM {_ENDS})
SELECT relation_id, sum(CASE WHEN relation = 'HAS_SUBTYPE' AND contains(quote, 'is a kind') THEN 3.0 WHEN relation = 'PART_OF' AND contains(quote, 'is part of') THEN 3.0 WHEN relation = 'CAUSES' AND contains(quote, 'leads to') THEN 3.0 ELSE 0.0 END)::DOUBLE AS signal FROM q GROUP BY relation_id"""
)
def direction_signal(spark: SparkSession, base: str) -> DataFrame:
    """T37 over quotes that state each relation's names in known phrases."""
    e = _ends(spark, base)
    a, b = F.col("a_canonical_name"), F.col("b_canonical_name")
    quotes = F.array(F.concat(F.lit("A "), b, F.lit(" is a kind of "), a, F.lit(".")), F.concat(a, F.lit(" is part of "), b), F.concat(a, F.lit(" leads to "), b))
    q = e.select("relation_id", "relation", a.alias("s"), b.alias("t"), F.explode(quotes).alias("quote"))
    signal = T.direction_signal(F.col("quote"), F.col("s"), F.col("t"), F.coalesce("relation", F.lit("")))
    return q.groupBy("relation_id").agg(F.sum(signal).alias("signal"))


@query(V.sql("g_concept") + "SELECT DISTINCT name, trim(regexp_replace(regexp_replace(regexp_replace(name, '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Za-z])([0-9])', '\\1 \\2', 'g')) AS words FROM g_concept")
def split_names(spark: SparkSession, base: str) -> DataFrame:
    """T20 over names written together."""
    return V.concepts(spark, base).select("name", T.split_pascal(F.col("name")).alias("words")).distinct()


@query()
def segment_words(spark: SparkSession, base: str) -> DataFrame:
    """Names without case as the fewest words of their own canonical name's dictionary."""
    c = V.concepts(spark, base)
    return c.select("concept_id", F.array_join(T.segment(F.lower("name"), F.split(F.lower("canonical_name"), " ")), " ").alias("words"))


@query()
def sequence_ratios(spark: SparkSession, base: str) -> DataFrame:
    """T38 between the names at the ends of every relation."""
    return _ends(spark, base).select("relation_id", F.round(T.sequence_ratio("a_canonical_name", "b_canonical_name"), 6).alias("ratio"))


@query("""WITH l AS (SELECT chunk_id, unnest(string_split(text, chr(10))) AS line FROM section_chunks),
t AS (SELECT trim(regexp_replace(trim(regexp_replace(line, '[ \\t\\r]+', ' ', 'g')), '^[0-9]+(\\.[0-9]+)+ ', '')) AS term, chunk_id FROM l WHERE regexp_matches(line, '^[0-9]+(\\.[0-9]+)+ [A-Z][^.!?]{2,58}$'))
SELECT lower(term) AS seed, min(term) AS shown, count(*) AS occurrences, count(DISTINCT chunk_id) AS chunks, CASE WHEN count(DISTINCT chunk_id) >= 2 THEN 10 ELSE 8 END AS priority FROM t
WHERE length(term) BETWEEN 3 AND 60 GROUP BY lower(term)""")
def seed_rank(spark: SparkSession, base: str) -> DataFrame:
    """Terms of numbered headings, counted and ranked."""
    lines = table(spark, base, "section_chunks").select("chunk_id", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike("^[0-9]+(\\.[0-9]+)+ [A-Z][^.!?]{2,58}$"))
    flat = F.trim(F.regexp_replace("line", "[ \\t\\r]+", " "))
    t = lines.select("chunk_id", F.trim(F.regexp_replace(flat, "^[0-9]+(\\.[0-9]+)+ ", "")).alias("term")).where(F.length("term").between(3, 60))
    return t.groupBy(F.lower("term").alias("seed")).agg(F.min("term").alias("shown"), F.count(F.lit(1)).alias("occurrences"), F.countDistinct("chunk_id").alias("chunks")).withColumn("priority", F.when(F.col("chunks") >= 2, 10).otherwise(8))
