"""Bayesian scores of pairs: one grouped aggregate, then arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as sc
from ..functions.labels import ladder
from .evidence import outcome_counts


def score_pairs(edges: DataFrame, min_evidence: int = 1, quantiles: bool = True) -> DataFrame:
    """Every (source, target) with its posterior; the evidence count includes neutral studies.

    ``quantiles`` adds the conservative score and the 95% interval, which take an Arrow UDF.
    """
    c = outcome_counts(edges, ["source", "target"]).withColumn("evidence_count", F.col("pos") + F.col("neg") + F.col("neutral")).filter(F.col("evidence_count") >= min_evidence)
    pos, neg = F.col("pos"), F.col("neg")
    out = c.withColumns({
        "score": sc.posterior_mean(pos, neg), "variance": F.when(pos + neg > 0, sc.posterior_variance(pos, neg)),
        "confidence": sc.posterior_confidence(pos, neg), "bayes_factor": sc.bayes_factor(pos, neg),
    })
    if quantiles:
        a, b = (pos + 1).cast("double"), (neg + 1).cast("double")
        out = out.withColumns({"conservative": sc.conservative_score(pos, neg), "low": sc.beta_quantile(F.lit(0.025), a, b), "high": sc.beta_quantile(F.lit(0.975), a, b)})
    return out


def compare(scores: DataFrame, first: str, second: str) -> DataFrame:
    """Two interventions on each condition that both have scores for, by score times confidence."""
    a = scores.filter(F.col("source") == first).select("target", (F.col("score") * F.col("confidence")).alias("a"))
    b = scores.filter(F.col("source") == second).select("target", (F.col("score") * F.col("confidence")).alias("b"))
    gap = F.abs(F.col("a") - F.col("b"))
    return a.join(b, "target").withColumns({"winner": ladder((gap < 1e-9, "tie"), (F.col("a") > F.col("b"), first), otherwise=second), "margin": gap})
