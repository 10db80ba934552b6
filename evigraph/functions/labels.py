"""Literal maps and threshold ladders. The first rung that holds wins, so order matters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Outcome words and their weights.
OUTCOME_WEIGHTS = {"improves": 1.0, "worsens": -1.0, "no_effect": 0.0, "inconclusive": 0.3}
#: Older words for the same outcomes.
OUTCOME_ALIASES = {"positive": "improves", "negative": "worsens", "neutral": "no_effect", "mixed": "inconclusive"}
#: Confidence words and their numbers.
CONFIDENCE_WORDS = {"very high": 0.9, "high": 0.75, "medium": 0.5, "low": 0.25, "very low": 0.1}


def steady(col: Column) -> Column:
    """Nine digits: a mean that lies on a bar does so in whatever order it was summed."""
    return F.round(col, 9)


def as_is(col: Column) -> Column:
    """For means that are summed in the table's order, and so have the last digits that the SQL compares."""
    return col


def lookup(col: Column, table: dict, default=None) -> Column:
    """A literal map's value for a key."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(entries, col)
    return found if default is None else F.coalesce(found, F.lit(default))


def ladder(*rungs: tuple[Column, object], otherwise=None) -> Column:
    out = None
    for condition, value in rungs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def outcome_weight(outcome: Column) -> Column:
    return lookup(outcome, OUTCOME_WEIGHTS, 0.0)


def canonical_outcome(outcome: Column) -> Column:
    """Both vocabularies to the stored one; null, empty and unknown words mean no effect."""
    word = F.lower(F.trim(outcome))
    known = lookup(word, {**{w: w for w in OUTCOME_WEIGHTS}, **OUTCOME_ALIASES})
    return F.coalesce(known, F.lit("no_effect"))


def display_outcome(outcome: Column) -> Column:
    return F.when(outcome == "inconclusive", "unsure").otherwise(outcome)


def advice(score: Column, confidence: Column, count: Column, hold: Callable[[Column], Column] = steady) -> Column:
    """What a pair's evidence amounts to; bars are held against ``hold`` of score and confidence."""
    score, confidence = hold(score), hold(confidence)
    return ladder(
        ((score > 0.5) & (confidence > 0.7) & (count >= 3), "Strongly recommended - robust positive evidence"),
        ((score > 0.3) & (confidence > 0.5), "Recommended - moderate positive evidence"),
        (score < -0.3, "Not recommended - evidence suggests ineffective"),
        (count < 2, "Insufficient evidence - more research needed"),
        otherwise="Neutral - mixed or weak evidence",
    )


def evidence_level(count: Column, confidence: Column, hold: Callable[[Column], Column] = steady) -> Column:
    confidence = hold(confidence)
    return ladder(
        ((count >= 10) & (confidence >= 0.75), "strong"),
        ((count >= 5) & (confidence >= 0.6), "moderate"),
        ((count >= 2) & (confidence >= 0.4), "weak"),
        otherwise="insufficient",
    )


def innovation_stage(age_days: Column, growth: Column, count: Column) -> Column:
    return ladder(
        ((age_days < 365) & (growth > 0.5), "breakthrough"),
        ((age_days < 730) & (growth > 0.3), "rising_star"),
        (count > 50, "established"),
        (age_days > 1825, "mature"),
        otherwise="emerging",
    )


def similarity_tier(similarity: Column) -> Column:
    return ladder((similarity >= 0.9, "HIGH"), (similarity >= 0.85, "MEDIUM"), otherwise="LOW")


def confidence_bucket(confidence: Column) -> Column:
    return ladder((confidence >= 0.8, "high (>=0.8)"), (confidence >= 0.6, "medium (0.6-0.8)"), (confidence > 0, "low (0.1-0.6)"), otherwise="none (0)")


def default_confidence(confidence: Column) -> Column:
    """Null and zero count as one half; one is the most."""
    return F.least(F.when(confidence.isNull() | (confidence == 0), 0.5).otherwise(confidence), F.lit(1.0))


def gap_priority(score: Column, innovation: Column, sources: Column) -> Column:
    return ladder(((score >= 0.8) & (innovation >= 0.7), "HIGH"), ((score >= 0.7) & (sources >= 2), "HIGH"), (score >= 0.6, "NORMAL"), otherwise="LOW")


def gap_confidence(sources: Column, strength: Column) -> Column:
    return ladder(
        ((sources >= 3) & (strength >= 0.7), "VERY HIGH - Multiple strong indicators"),
        ((sources >= 2) & (strength >= 0.6), "HIGH - Strong evidence from similar conditions"),
        ((sources >= 2) | (strength >= 0.5), "MODERATE - Some supporting evidence"),
        otherwise="LOW - Limited evidence available",
    )


def failure_advice(confidence: Column, failure_rate: Column, avoid: float = 0.8) -> Column:
    return ladder((confidence >= avoid, "AVOID"), (failure_rate >= 0.7, "UNLIKELY TO HELP"), otherwise="INCONCLUSIVE")


def innovation_class(index: Column, breakthrough: Column, growth: Column) -> Column:
    return ladder(
        ((index >= 0.85) & (breakthrough >= 0.4), "BREAKTHROUGH - Rapidly emerging with strong results"),
        ((index >= 0.75) & (growth >= 0.6), "RISING STAR - Growing evidence base"),
        (index >= 0.6, "EMERGING - Early evidence shows promise"),
        (index >= 0.4, "ESTABLISHED - Well-supported treatment option"),
        (index >= 0.25, "MATURE - Well-understood, stable"),
        otherwise="LEGACY - Historical treatment, limited new research",
    )


def diversity_severity(mean_similarity: Column) -> Column:
    """NONE from 0.40 up, MODERATE from 0.30 up, SEVERE below."""
    return ladder((mean_similarity >= 0.4, "NONE"), (mean_similarity >= 0.3, "MODERATE"), otherwise="SEVERE")


def auto_approval(relation: Column, confidence: Column, quality_ok: Column, severity: Column) -> Column:
    """The reason against approving a merge; null approves."""
    return ladder(
        (relation == "DIFFERENT", "classified as different"),
        (confidence != "HIGH", "low confidence"),
        (~quality_ok, "poor name quality"),
        (severity == "SEVERE", "severe diversity warning"),
        otherwise=None,
    )
