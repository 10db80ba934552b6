"""Bayesian scoring (M1 to M7)."""

from pyspark.sql import functions as F

from ..operators import bayes
from ..operators import evidence as ev
from ..sources.tables import canonical, edges, edges_sparse
from .aggregates import POOLED
from .registry import CANONICAL, EDGES, SPARSE, query, r6

COUNTS = """, k AS (SELECT source, target, count(CASE WHEN outcome = 'improves' THEN 1 END) AS pos, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS neg, count(CASE WHEN outcome = 'no_effect' THEN 1 END) AS neutral FROM {t} GROUP BY ALL),
b AS (SELECT *, CASE WHEN pos + neg = 0 THEN 0.5 ELSE (pos + 1.0) / (pos + neg + 2.0) END::DOUBLE AS score, (pos + 1.0::DOUBLE) * (neg + 1.0) / (power(pos + neg + 2.0, 2) * (pos + neg + 3.0)) AS v, pos + neg + neutral AS evidence_count FROM k),
s AS (SELECT *, CASE WHEN pos + neg = 0 THEN 0 ELSE sqrt(least(1, ln(1 + pos + neg) / ln(101)) * (1 - least(v * 10, 1))) END AS confidence, CASE WHEN pos + neg = 0 THEN 1 ELSE least((pos + 1.0) / (neg + 1.0), 100) END::DOUBLE AS bayes_factor FROM b WHERE evidence_count >= 1)"""
_SHOWN = "source, target, pos, neg, neutral, evidence_count, round(score, 6) AS score, round(CASE WHEN pos + neg > 0 THEN v END, 6) AS variance, round(confidence, 6) AS confidence, round(bayes_factor, 6) AS bayes_factor"


def _rounded(scores):
    return scores.withColumns({c: r6(c) for c in ("score", "variance", "confidence", "bayes_factor")})


@query("m1_posterior_scores", COUNTS.format(t="sparse") + f" SELECT {_SHOWN} FROM s", (SPARSE,))
def m1(spark, d, sparse=edges_sparse):
    return _rounded(bayes.score_pairs(sparse(spark, d), quantiles=False))


@query("m2_posterior_quantiles")
def m2(spark, d, sparse=edges_sparse):
    s = bayes.score_pairs(sparse(spark, d))
    return s.select("source", "target", "pos", "neg", r6("conservative").alias("conservative"), r6("low").alias("low"), r6("high").alias("high"))


@query("m5_pairwise_comparison", COUNTS.format(t="edges") + """, x AS (SELECT a.target, a.score * a.confidence AS a, b.score * b.confidence AS b FROM s a JOIN s b ON a.target = b.target WHERE a.source = 'Supplier#000000001' AND b.source = 'Supplier#000000002')
  SELECT target, round(a, 6) AS a, round(b, 6) AS b, CASE WHEN abs(a - b) < 1e-9 THEN 'tie' WHEN a > b THEN 'Supplier#000000001' ELSE 'Supplier#000000002' END AS winner, round(abs(a - b), 6) AS margin FROM x""", (EDGES,))
def m5(spark, d):
    e = edges(spark, d).filter(F.col("source").isin("Supplier#000000001", "Supplier#000000002"))
    out = bayes.compare(bayes.score_pairs(e, quantiles=False), "Supplier#000000001", "Supplier#000000002")
    return out.withColumns({c: r6(c) for c in ("a", "b", "margin")})


@query("m6_pooled_scores", COUNTS.format(t="pooled") + f" SELECT {_SHOWN} FROM s WHERE evidence_count >= 5", (EDGES, CANONICAL, POOLED))
def m6(spark, d):
    return _rounded(bayes.score_pairs(ev.pool(edges(spark, d), canonical(spark, d)), 5, quantiles=False))


@query("m7_interventions_for_condition", "SELECT DISTINCT coalesce(c.canonical_name, e.source) AS intervention FROM sparse e LEFT JOIN canonical c ON e.source = c.entity_name WHERE e.target = 'Brand#11'", (SPARSE, CANONICAL))
def m7(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "canonical_name")
    return sparse(spark, d).filter("target = 'Brand#11'").join(names, "source", "left").select(F.coalesce("canonical_name", "source").alias("intervention")).distinct()
