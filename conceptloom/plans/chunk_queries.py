"""Queries on chunking, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking as C
from ..session import scratch_path, table
from ..sources import documents as D
from ..streaming import ingest
from . import sqltext as S
from . import views as V
from .registry import registry

QUERIES, ORACLES, query = registry()


def _pages(spark: SparkSession, base: str) -> DataFrame:
    """Page texts of section chunks by their offsets; chunks are the documents."""
    s = table(spark, base, "section_chunks").where("text IS NOT NULL AND size(pages) > 0").groupBy("chunk_id").agg(F.max_by(F.struct("text", "pages", "page_offsets"), "loaded_at").alias("r")).select("chunk_id", "r.*")
    ends = F.concat(F.slice("page_offsets", 2, F.size("page_offsets")), F.array(F.length("text")))
    each = s.select(F.col("chunk_id").alias("doc"), "text", F.explode(F.arrays_zip(F.col("pages").alias("page"), F.col("page_offsets").alias("a"), ends.alias("b"))).alias("p"))
    return each.select("doc", F.col("p.page").alias("page"), F.col("text").substr(F.col("p.a") + 1, F.col("p.b") - F.col("p.a")).alias("text"))


def _sections(spark: SparkSession, base: str) -> list[str]:
    """Registered sections: a curriculum's list, checked to be small before it is sent."""
    found = [r[0] for r in table(spark, base, "section_chunks").select(F.explode("sections").alias("s")).where("s IS NOT NULL").distinct().limit(100_001).collect()]
    if len(found) > 100_000:
        raise ValueError("too many sections for a registry")
    return found


@query()
def chunk_documents(spark: SparkSession, base: str) -> DataFrame:
    """Pages to chunks by sections."""
    return C.chunk_documents(_pages(spark, base), _sections(spark, base)).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


@query("""WITH s AS (SELECT chunk_id AS doc, arg_max(text, loaded_at) AS text FROM section_chunks WHERE text IS NOT NULL AND len(pages) > 0 GROUP BY 1) SELECT doc, 0 AS too_long, 0 AS lost_words FROM s WHERE regexp_matches(text, '[^{0}]')""".replace("{0}", S.SPACES))
def chunk_invariants(spark: SparkSession, base: str) -> DataFrame:
    """That no chunk is above the size, but for a word that alone is, and that every word of a document stands in a chunk."""
    pages = _pages(spark, base)
    words = lambda c: F.array_distinct(F.filter(F.split(c, f"[{T.SPACES}]+"), lambda w: w != ""))
    chunks = C.chunk_documents(pages, _sections(spark, base)).withColumn("w", words("text"))
    state = chunks.groupBy("doc").agg(F.count_if((F.length("text") > 2000) & F.forall("w", lambda w: F.length(w) <= 800)).alias("too_long"), F.array_distinct(F.flatten(F.collect_list("w"))).alias("held"))
    own = pages.groupBy("doc").agg(words(F.concat_ws("\n", F.collect_list("text"))).alias("w")).where(F.size("w") > 0)
    return own.join(state, "doc", "left").select("doc", "too_long", F.size(F.array_except("w", F.coalesce("held", F.array().cast("array<string>")))).alias("lost_words"))


@query()
def split_long(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned chunks cut below the hard limit."""
    return C.postprocess(V.chunks(spark, base).where("text IS NOT NULL"), "chunk_id", "text").select("chunk_id", "part", "text_length", F.md5("text").alias("text_key"))


@query("""WITH h AS (SELECT chunk_id, regexp_extract(line, '^\\s*([0-9]+\\.[0-9]+(?:\\.[0-9]+)*)\\s+[^ \\t]', 1) AS section FROM (SELECT chunk_id, unnest(string_split(text, chr(10))) AS line FROM section_chunks)) SELECT section, count(DISTINCT chunk_id) AS chunks FROM h WHERE section <> '' GROUP BY section""")
def leading_sections(spark: SparkSession, base: str) -> DataFrame:
    """Numbered headings and the chunks that have them."""
    h = table(spark, base, "section_chunks").select("chunk_id", F.explode(F.split("text", "\n")).alias("line")).select("chunk_id", F.regexp_extract("line", "^\\s*([0-9]+\\.[0-9]+(?:\\.[0-9]+)*)\\s+[^ \\t]", 1).alias("section"))
    return h.where("section <> ''").groupBy("section").agg(F.countDistinct("chunk_id").alias("chunks"))


_HEAD = "h AS (SELECT DISTINCT chapter_id AS doc, unnest(sections) AS section, least(page_start, page_end) AS page FROM section_chunks WHERE chapter_id IS NOT NULL AND page_start IS NOT NULL AND page_end IS NOT NULL), s AS (SELECT doc, section, min(page) AS first FROM h GROUP BY 1, 2), n AS (SELECT doc, first, lead(first) OVER (PARTITION BY doc ORDER BY first) AS next FROM (SELECT DISTINCT doc, first FROM s)), r AS (SELECT doc, section, first, greatest(first, coalesce(next - 1, 720)) AS last FROM s JOIN n USING (doc, first))"


def _headings(spark: SparkSession, base: str) -> DataFrame:
    s = table(spark, base, "section_chunks").where("chapter_id IS NOT NULL AND page_start IS NOT NULL AND page_end IS NOT NULL")
    return s.select(F.col("chapter_id").alias("doc"), F.explode("sections").alias("section"), F.least("page_start", "page_end").alias("page")).distinct()


@query("WITH " + _HEAD + " SELECT * FROM r")
def heading_ranges(spark: SparkSession, base: str) -> DataFrame:
    """Pages of sections from their first headings."""
    return C.section_ranges(_headings(spark, base), 720)


@query("WITH " + _HEAD + ", p AS (SELECT doc, section, unnest(range(first, last + 1)) AS page FROM r) SELECT doc, page::INT AS page, count(*) AS sections FROM p GROUP BY ALL")
def page_provenance(spark: SparkSession, base: str) -> DataFrame:
    """Sections of every page."""
    return C.section_pages(C.section_ranges(_headings(spark, base), 720)).groupBy("doc", "page").agg(F.count(F.lit(1)).alias("sections"))


@query("SELECT chapter_id AS doc, max(greatest(page_start, page_end)) AS last_page FROM section_chunks WHERE NOT regexp_matches(coalesce(text, ''), '(?im)^\\s*([0-9.]+\\s+)?(summary|exercises|further reading|bibliography)\\s*$') GROUP BY chapter_id")
def body_end(spark: SparkSession, base: str) -> DataFrame:
    """The last page of a chapter's body."""
    end = F.regexp_like(F.coalesce("text", F.lit("")), F.lit("(?im)^\\s*([0-9.]+\\s+)?(summary|exercises|further reading|bibliography)\\s*$"))
    return table(spark, base, "section_chunks").where(~end).groupBy(F.col("chapter_id").alias("doc")).agg(F.max(F.greatest("page_start", "page_end")).alias("last_page"))


@query("WITH s AS (SELECT DISTINCT chapter_id, unnest(sections) AS section FROM section_chunks WHERE chapter_id IS NOT NULL) SELECT s.chapter_id, section FROM s JOIN chapters c USING (chapter_id) WHERE try_cast(split_part(section, '.', 1) AS INT) = chapter_num")
def expected_sections(spark: SparkSession, base: str) -> DataFrame:
    """Sections that bear their chapter's number."""
    s = table(spark, base, "section_chunks").where("chapter_id IS NOT NULL").select("chapter_id", F.explode("sections").alias("section")).distinct()
    return s.join(F.broadcast(table(spark, base, "chapters").select("chapter_id", "chapter_num")), "chapter_id").where(F.substring_index("section", ".", 1).try_cast("int") == F.col("chapter_num")).select("chapter_id", "section")


@query(V.sql("g_concept") + ", n AS (SELECT concept_id, chapter_id, row_number() OVER (PARTITION BY chapter_id ORDER BY concept_id) AS k FROM g_concept WHERE chapter_id IS NOT NULL) SELECT concept_id, printf('CH%02d_%s_KP%03d', split_part(chapter_id, 'ch', 2)::INT, 'sec', k) AS local_id FROM n")
def section_bridge(spark: SparkSession, base: str) -> DataFrame:
    """Local ids of a chapter's concepts."""
    from pyspark.sql import Window

    c = V.concepts(spark, base).where("chapter_id IS NOT NULL")
    k = F.row_number().over(Window.partitionBy("chapter_id").orderBy("concept_id"))
    return c.withColumn("k", k).select("concept_id", T.local_id(F.regexp_extract("chapter_id", "ch(\\d+)", 1), F.lit(None).cast("string"), F.col("k")).alias("local_id"))


@query(V.sql("g_chunk") + "SELECT chunk_id, ((row_number() OVER (PARTITION BY chapter_id ORDER BY chunk_id) - 1) // 8)::BIGINT AS batch FROM g_chunk")
def batches(spark: SparkSession, base: str) -> DataFrame:
    """Chunks in batches of eight by chapter."""
    return C.batches(V.chunks(spark, base), "chapter_id", "chunk_id", 8).select("chunk_id", "batch")


@query(V.sql("g_relation") + ", e AS (SELECT relation_id, unnest(evidence) AS e FROM g_relation) SELECT relation_id, e.chunk_id AS chunk_id, count(*) AS quotes FROM e GROUP BY ALL")
def explode_decisions(spark: SparkSession, base: str) -> DataFrame:
    """Nested evidence as rows."""
    return V.relations(spark, base).select("relation_id", F.explode("evidence").alias("e")).groupBy("relation_id", F.col("e.chunk_id").alias("chunk_id")).agg(F.count(F.lit(1)).alias("quotes"))


@query("SELECT chapter_id, count(*) AS documents, sum(length(text)) AS chars, md5(string_agg(md5(text), ',' ORDER BY doc_id)) AS key FROM documents WHERE text IS NOT NULL GROUP BY chapter_id")
def collect_text(spark: SparkSession, base: str) -> DataFrame:
    """Texts of a chapter as one key, gathered by their hashes and never as texts."""
    d = table(spark, base, "documents").where("text IS NOT NULL").select("chapter_id", "doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))
    return d.groupBy("chapter_id").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("chars"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "h"))), lambda r: r["h"]), ",")).alias("key"))


@query(V.sql("g_concept") + "SELECT concept_id, canonical_name FROM g_concept WHERE upper(trim(status)) = 'APPROVED'")
def registry_scan(spark: SparkSession, base: str) -> DataFrame:
    """A registry written as JSON and read again; only approved concepts come back."""
    path = scratch_path(spark, "registry")
    c = V.concepts(spark, base).select("concept_id", "canonical_name", "aliases", "name_zh", "short_definition", F.upper(F.trim("status")).alias("status"), "broader_concept_id")
    c.write.json(path)
    rows = spark.read.schema("concept_id STRING, canonical_name STRING, aliases ARRAY<STRING>, status STRING").json(path)
    return D.assert_unique(rows, ["concept_id"]).where("status = 'APPROVED'").select("concept_id", "canonical_name")


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def log_scan(spark: SparkSession, base: str) -> DataFrame:
    """Events appended to a log and read back, the last of each user."""
    path = scratch_path(spark, "log")
    D.append_log(table(spark, base, "events").select("user_id", "event_id", "value", F.col("event_id").alias("seq")), path)
    return D.read_log(spark, path, "user_id LONG, event_id LONG, value DOUBLE, seq LONG", "user_id").select("user_id", "event_id", "value")


@query("SELECT user_id, max(value) AS value, count(*) AS n FROM events GROUP BY user_id")
def stream_upsert(spark: SparkSession, base: str) -> DataFrame:
    """2.14: events as a stream of files, merged by user into a table of generations."""
    path = scratch_path(spark, "stream")
    events = table(spark, base, "events")
    per_file = events.groupBy("user_id", "event_type").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    per_file.write.partitionBy("event_type").parquet(f"{path}/in")
    stream = spark.readStream.schema("user_id LONG, value DOUBLE, n LONG, event_type STRING").option("maxFilesPerTrigger", 64).parquet(f"{path}/in")
    kept = ingest.Generations(spark, f"{path}/table")

    def merge(batch: DataFrame, number: int) -> None:
        from ..operators.merge import merge_upsert

        if (kept.last() or 0) > number:
            return
        incoming = batch.groupBy("user_id").agg(F.max("value").alias("value"), F.sum("n").alias("n"))
        now = kept.read()
        kept.write(incoming if now is None else merge_upsert(now, incoming, ["user_id"], {"value": "maximum", "n": "add"}), number + 1)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return kept.read()


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def window_counts(spark: SparkSession, base: str) -> DataFrame:
    """2.14: events by hour and type; the same plan runs on a stream with a watermark."""
    return ingest.windowed_counts(table(spark, base, "events"))
