"""Types of old hierarchy edges by tables and by the words of names; the first rule that fits holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words in names of structures, mechanisms, parts, callables and interfaces.
STRUCTURES = "Structure Struct ControlBlock Header Record Object Descriptor Table Layout Block Packet Frame".split()
MECHANISMS = "System Facility Mechanism Architecture Framework Hierarchy Classification Communication MessagePassing ProcedureCall Channel Port Pipe ContextSwitch Swapping Scheduling ProcessState MemoryLayout".split()
PARTS = "Space Region Segment Section Area Handle Descriptor Pointer Counter Register Information Status Limit Number List Table Entry Header Port Stub Daemon Buffer Object Queue Stream Reader Writer".split()
CALLABLES = "Function SystemCall Primitive Operation Command Method Call".split()
INTERFACES = "API ApplicationProgrammingInterface Interface SystemCall Function Primitive Operation Command".split()
# Phrases by which a definition says that something is a kind of another.
KIND_PHRASES = ["kind of", "type of", "specific type", "specific instance", "是一種", "具體類型", "特定類型"]
# Transitions between states of a process.
TRANSITIONS = [("NewState", "ReadyState"), ("ReadyState", "RunningState"), ("RunningState", "WaitingState"), ("WaitingState", "ReadyState"), ("RunningState", "TerminatedState"), ("RunningState", "ReadyState")]


def _has(words: list[str], name: Column) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(name, w))


def _tokens(name: Column) -> Column:
    apart = F.regexp_replace(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", " "), "[^A-Za-z0-9]+", " ")
    return F.array_distinct(F.filter(F.split(F.lower(apart), " "), lambda t: t != ""))


def structure_types(edges: DataFrame, concepts: DataFrame, categories: DataFrame, forced: DataFrame) -> DataFrame:
    """``parent``, ``child``, ``relation``, ``confidence``, ``review`` of hierarchy edges.

    concepts: ``name``, ``definition``, ``aliases``; categories: ``name`` of parents whose children are kinds; forced: ``parent``, ``child``,
    ``relation``, ``confidence`` - both are data of a deployment. The order: state transitions, forced types, members of interfaces,
    parts of structures, kinds of a category, parts of a mechanism, names within names, definitions; all else is for review. Names
    without a concept have no definition; edges with a null end have no row.
    """
    kept = edges.where("parent IS NOT NULL AND child IS NOT NULL").select("parent", "child").distinct()
    facts = concepts.groupBy("name").agg(F.first(F.struct(F.coalesce("definition", F.lit("")).alias("text"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))).alias("f"))
    rows = kept.join(facts.withColumnRenamed("name", "child"), "child", "left")
    rows = rows.join(categories.select(F.col("name").alias("parent"), F.lit(True).alias("_category")).distinct(), "parent", "left")
    rows = rows.join(forced.select("parent", "child", F.col("relation").alias("_forced"), F.col("confidence").alias("_sure")), ["parent", "child"], "left")
    p, c = F.col("parent"), F.col("child")
    text = F.lower(F.coalesce("f.text", F.lit("")))
    said = F.concat_ws(" ", F.lower(c), text, F.lower(F.array_join(F.coalesce("f.aliases", F.array().cast("array<string>")), " ")))
    callable_ = _has(CALLABLES, c) | F.lower(c).rlike("(call|function|method)$")
    part, within = _has(PARTS, c), (p != c) & (F.size(_tokens(p)) > 0) & (F.size(F.array_except(_tokens(p), _tokens(c))) == 0)
    a_kind = F.contains(text, F.concat(F.lit("is a "), F.lower(p))) | F.contains(text, F.concat(F.lit("is an "), F.lower(p))) | _has(["是一種", "specific instance", "特定類型", "具體類型"], text)
    category = F.coalesce("_category", F.lit(False))
    moves = F.exists(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in TRANSITIONS)), lambda t: (t["a"] == p) & (t["b"] == c))
    rules = [
        (moves, "STATE_TRANSITION", F.lit(0.96)),
        (F.col("_forced").isNotNull(), None, F.col("_sure")),
        (_has(INTERFACES, p) & callable_, "API_MEMBER_OF", F.lit(0.90)),
        (_has(INTERFACES, p) & (_has(STRUCTURES, c) | part), "API_MEMBER_OF", F.lit(0.86)),
        (_has(STRUCTURES, p) & part, "HAS_FIELD", F.lit(0.92)),
        (_has(STRUCTURES, p), "HAS_COMPONENT", F.lit(0.82)),
        (category & _has(KIND_PHRASES, said), "IS_A", F.lit(0.88)),
        (category & within, "IS_A", F.lit(0.84)),
        (category & (c.endswith(p) | c.startswith(p)), "IS_A", F.lit(0.82)),
        (_has(MECHANISMS, p) & callable_, "API_MEMBER_OF", F.lit(0.82)),
        (_has(MECHANISMS, p), "HAS_COMPONENT", F.lit(0.80)),
        (within, "IS_A", F.lit(0.76)),
        (a_kind, "IS_A", F.lit(0.78)),
    ]
    kind = sure = None
    for condition, relation, confidence in rules:
        name = F.col("_forced") if relation is None else F.lit(relation)
        kind = F.when(condition, name) if kind is None else kind.when(condition, name)
        sure = F.when(condition, confidence) if sure is None else sure.when(condition, confidence)
    return rows.select("parent", "child", kind.otherwise("RELATED_TO").alias("relation"), sure.otherwise(0.50).alias("confidence"), kind.isNull().alias("review"))


def coverage_rules(texts: DataFrame, text: str, keywords: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of every rule all of whose keywords stand in the texts, case aside.

    keywords: ``rule``, ``keyword``; rows: ``rule`` and what the rule adds. A rule needs its keywords anywhere in the texts, not in one.
    Tables of rules are data of a deployment and small; each text is met once.
    """
    words = keywords.select("rule", F.lower("keyword").alias("keyword")).distinct()
    listed = [r[0] for r in words.select("keyword").distinct().limit(10_001).collect()]
    if len(listed) > 10_000:
        raise ValueError("keywords of coverage rules are no small table")
    low = F.lower(F.col(text))
    there = texts.select(F.explode(F.array_compact(F.array(*(F.when(F.contains(low, F.lit(w)), w) for w in listed)))).alias("keyword")).distinct() if listed else words.select("keyword").limit(0)
    fired = words.join(there.withColumn("_there", F.lit(True)), "keyword", "left").groupBy("rule").agg(F.bool_and(F.coalesce("_there", F.lit(False))).alias("_all")).where("_all").select("rule")
    return rows.join(fired, "rule", "left_semi")
