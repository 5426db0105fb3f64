"""Concept sets: from a hierarchy or from code patterns to ids that select events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.functions import any_flag, code_matches
from indexday.operators.sizing import broadcast_if_small
from indexday.spec import CodeGroup, CodeSet


def concepts_below(ancestry: DataFrame, concept: DataFrame, ancestors: Sequence[int]) -> DataFrame:
    """Descendants of the ancestors that exist as concepts.

    The few rows of the hierarchy below the ancestors go to the vocabulary, not the other way
    round, so the vocabulary is read in place.
    """
    below = ancestry.filter(F.col("ancestor_concept_id").isin(*ancestors)).select(
        F.col("descendant_concept_id").alias("concept_id")
    )
    return concept.select("concept_id").join(broadcast_if_small(below), "concept_id", "left_semi")


def expand_concepts(ancestry: DataFrame, concept: DataFrame, ancestors: Sequence[int]) -> DataFrame:
    """The concept set as a result: each id once."""
    return concepts_below(ancestry, concept, ancestors).distinct()


def code_map(concept: DataFrame, groups: Sequence[CodeGroup]) -> DataFrame:
    """One row per concept that is in some group, with a 0/1 column per group.

    The patterns run once over the vocabulary, never over events, and a concept in several
    groups stays one row, so joining the map does not multiply events.
    """
    flags = []
    for g in groups:
        hit = code_matches("concept_code", g.prefixes, g.codes)
        if g.vocabulary is not None:
            if "vocabulary_id" not in concept.columns:
                raise ValueError(f"group {g.name} names a vocabulary, but concept has no vocabulary_id")
            hit = hit & (F.col("vocabulary_id") == g.vocabulary)
        flags.append(F.when(hit, 1).otherwise(0).alias(g.name))
    return concept.select("concept_id", *flags).filter(any_flag(*[g.name for g in groups]))


def in_concepts(events: DataFrame, code: str, concepts: DataFrame) -> DataFrame:
    """Events whose code is in the set."""
    ids = broadcast_if_small(concepts.select(F.col("concept_id").alias(code)))
    return events.join(ids, code, "left_semi")


def tag_by_map(events: DataFrame, code: str, mapping: DataFrame) -> DataFrame:
    """Events found in a code map, with the map's 0/1 columns."""
    return events.join(broadcast_if_small(mapping), events[code] == mapping["concept_id"]).drop("concept_id")


def tag_by_ids(events: DataFrame, code: str, sets: Sequence[CodeSet]) -> DataFrame:
    """Events with a code in one of the listed sets, with a 0/1 column per set.

    The union of the lists is one IN filter that reaches the scan.
    """
    wanted = sorted({i for s in sets for i in s.ids})
    flags = [F.when(F.col(code).isin(*s.ids), 1).otherwise(0).alias(s.name) for s in sets]
    return events.filter(F.col(code).isin(*wanted)).select("*", *flags)
