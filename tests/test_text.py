from pyspark.sql import functions as F

from conceptloom.functions import text as T


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


def test_normalisation(spark):
    assert one(spark, T.normalize_text("t", True), t="Inter-\n process  ﬁle­ s ") == "interprocess file s"
    assert one(spark, T.normalize_text("t"), t=None) == ""
    assert one(spark, T.normalize_search("t"), t="Read/Write & C++_x") == "read write and c++ x"
    assert one(spark, T.normalize_name("t", True), t="Policies, Classes & Buses of Process Files") == "policy class and buse of process file"


def test_singular_keeps_what_is_no_plural(spark):
    got = [one(spark, T.singular(F.col("t")), t=w) for w in ("process", "bus", "basis", "physics", "files", "entries", "classes", "gas")]
    assert got == ["process", "bus", "basis", "physics", "file", "entry", "class", "gas"]


def test_phrases_quotes_and_scores(spark):
    assert one(spark, T.has_phrase(F.col("p"), F.col("t")), p="c++", t="the c++ heap")
    assert not one(spark, T.has_phrase(F.col("p"), F.col("t")), p="heap", t="the heaps")
    assert not one(spark, T.has_phrase(F.col("p"), F.col("t")), p="a.b", t="acb")
    assert one(spark, T.quote_in_text("q", "t"), q="inter process communication", t="An inter-process communication link")
    assert not one(spark, T.quote_in_text("q", "t"), q="", t="x")
    assert one(spark, T.clamp(F.col("c"), 0.5), c=float("nan")) == 0.5 and one(spark, T.clamp(F.col("c")), c=1.7) == 1.0
    assert one(spark, T.token_jaccard("a", "b"), a="Page Tables", b="page table walk") == 2 / 3
    assert one(spark, T.definition_overlap("a", "b"), a="the of", b="page") == 0.0


def test_sections(spark):
    assert one(spark, T.section_compatible(F.col("s"), F.col("o")), s="3.1", o=["3.1.2"])
    assert not one(spark, T.section_compatible(F.col("s"), F.col("o")), s="3.1", o=["3.10"])
    assert one(spark, T.section_key(F.col("s")), s="3.10") == [3, 10] and one(spark, T.section_key(F.col("s")), s="x") == [9999]


def test_words_and_variants(spark):
    assert one(spark, T.split_pascal(F.col("t")), t="TCPSocketTable2") == "TCP Socket Table 2"
    assert one(spark, T.segment(F.col("t"), F.col("w")), t="pagetable", w=["page", "table", "pagetab", "le"]) == ["page", "table"]
    assert one(spark, T.auto_variants("t"), t="OS Page Table Service") == ["OS Page Table", "Page Table Service"]
    assert one(spark, T.sequence_ratio("a", "b"), a="abcd", b="bcde") == 0.75
    assert one(spark, T.json_object(F.col("t")), t="```json\n{\"a\": {\"b\": 1}}\n``` ok") == '{"a": {"b": 1}}'
    assert T.parse_chapters("3,5-7, 3") == [3, 5, 6, 7]


def test_direction(spark):
    s = T.direction_signal(F.col("q"), F.col("a"), F.col("b"), F.lit("HAS_SUBTYPE"))
    assert one(spark, s, q="A mutex is a kind of lock.", a="lock", b="mutex") == 3.0
    assert one(spark, s, q="A lock is a mutex.", a="lock", b="mutex") == -3.0
