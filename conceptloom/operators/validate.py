"""Validation of evidence and decisions on relations: one reason per record, the first that fits holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Formal relation types; the symmetric one.
RELATIONS = (
    "HAS_SUBTYPE PART_OF IMPLEMENTS USES INVOKES PROVIDES MANAGES ENABLES CAUSES EXAMPLE_OF CONTRASTED_WITH MAPS_TO REPRESENTS CONTAINS "
    "CREATES TRANSITIONS_TO SAVES_TO LOADS_FROM RECLAIMS WAITS_ON SCHEDULES INCREASES REDUCES"
).split()
SYMMETRIC = ["CONTRASTED_WITH"]
RELATION_FLOOR, PREREQUISITE_FLOOR = 0.82, 0.85


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule whose condition holds; null if none does."""
    out = None
    for condition, reason in rules:
        condition = F.coalesce(condition, F.lit(False))
        out = F.when(condition, reason) if out is None else out.when(condition, reason)
    return out


def evidence_reasons(mentions: DataFrame, order: str = "mention_id") -> DataFrame:
    """K2: adds ``reason`` (null: accepted) and ``kept`` to mentions joined with their concept.

    Needs ``known``, ``found`` (whether the quote stands in its chunk), ``evidence_type``, ``quote``, ``confidence``, ``concept_id``, ``chunk_id``,
    ``matches_definition`` and ``terms`` (made by ``anchor_terms``). Of accepted rows of a chunk with the same concept, type and
    normalised quote the first in ``order`` is kept.
    """
    floor = F.create_map(*(F.lit(x) for kv in T.EVIDENCE_FLOORS.items() for x in kv))
    judged = T.anchored(mentions, "terms", "quote", "evidence_type").withColumn(
        "reason",
        first_reason(
            (~F.col("known"), "unknown_or_non_candidate_concept"),
            (F.col("evidence_type").isNull(), "invalid_evidence_type"),
            (~F.coalesce(F.col("found"), F.lit(False)), "quote_not_found_in_chunk"),
            (F.col("confidence") < floor[F.col("evidence_type")], "below_evidence_confidence_threshold"),
            (F.col("anchor").isNull(), "quote_not_anchored_to_concept_name_alias_or_definition"),
            ((F.col("evidence_type") == "definition") & ~F.coalesce("matches_definition", F.lit(False)), "definition_not_confirmed_by_model"),
        ),
    )
    same = Window.partitionBy("concept_id", "chunk_id", "evidence_type", F.xxhash64(T.normalize_text("quote")), F.col("reason").isNull()).orderBy(order)
    return judged.withColumn("kept", F.col("reason").isNull() & (F.row_number().over(same) == 1))


def decide(relations: DataFrame, decisions: DataFrame, keep_missing: bool = False) -> DataFrame:
    """K4: relations after decisions ACCEPT, REVERSE, RETYPE or DROP; others and invalid new types drop.

    relations: ``relation_id``, ``source``, ``target``, ``relation``; decisions: ``relation_id``, ``action``, ``new_type``.
    """
    d = relations.join(decisions, "relation_id", "left")
    action = F.coalesce("action", F.lit("ACCEPT" if keep_missing else "DROP"))
    fine = action.isin("ACCEPT", "REVERSE") | ((action == "RETYPE") & F.coalesce(F.col("new_type").isin(RELATIONS), F.lit(False)))
    swap = action == "REVERSE"
    kind = F.when(action == "RETYPE", F.col("new_type")).otherwise(F.col("relation"))
    s, t = F.when(swap, F.col("target")).otherwise(F.col("source")), F.when(swap, F.col("source")).otherwise(F.col("target"))
    both = kind.isin(SYMMETRIC)
    return d.where(fine).select("relation_id", F.when(both, F.least(s, t)).otherwise(s).alias("source"), F.when(both, F.greatest(s, t)).otherwise(t).alias("target"), kind.alias("relation"))
