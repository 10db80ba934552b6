"""Scalar functions on hand-computed values."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evigraph.functions import labels, scoring, similarity, text, vectors


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_normalise_and_variants(spark):
    r = one(spark, text.normalize_term(F.lit("  Omega-3  (Fish   Oil)! ")), text.search_variants(F.lit("The Cold-exposure therapy")))
    assert r[0] == "omega 3 fish oil"
    assert r[1] == sorted({"the cold-exposure therapy", "the coldexposure therapy", "the cold exposure therapy", "the-cold-exposure-therapy", "cold-exposure therapy", "the cold-exposure"})


def test_posterior(spark):
    pos, neg = F.lit(3), F.lit(1)
    r = one(spark, scoring.posterior_mean(pos, neg), scoring.bayes_factor(pos, neg), scoring.posterior_variance(pos, neg), scoring.posterior_mean(F.lit(0), F.lit(0)), scoring.posterior_confidence(F.lit(0), F.lit(0)))
    assert r[0] == pytest.approx(4 / 6) and r[1] == 2.0 and r[2] == pytest.approx(8 / 252) and (r[3], r[4]) == (0.5, 0.0)


def test_wilson_laplace_consensus(spark):
    r = one(spark, scoring.laplace_score(F.lit(8), F.lit(10))[0], scoring.wilson_score(F.lit(8), F.lit(10))[0], *[scoring.consensus_confidence(F.lit(a), F.lit(n)) for a, n in ((7, 10), (10, 10), (35, 100))])
    assert r[0] == 0.75 and r[1] == pytest.approx(0.7168, abs=1e-4)
    assert [r[2], r[3], r[4]] == pytest.approx([0.7, 1.0, 0.35])


def test_decay_and_lift(spark):
    r = one(spark, scoring.decay(F.lit(1.0), F.lit(3), 3.0), scoring.lift(F.lit(1.0), F.lit(1.0)), scoring.lift(F.lit(0.0), F.lit(0.0)), scoring.lift(F.lit(1.0), F.lit(0.0)))
    assert r[0] == pytest.approx(0.5) and r[1] == 1.0 and r[2] == 0.0 and math.isinf(r[3])


def test_advice_ladder(spark):
    rows = spark.createDataFrame([(0.6, 0.8, 3), (0.4, 0.6, 1), (-0.4, 0.9, 9), (0.1, 0.9, 1)], "s double, c double, n int")
    words = [r[0].split(" ")[0] for r in rows.select(labels.advice(F.col("s"), F.col("c"), F.col("n"))).collect()]
    assert words == ["Strongly", "Recommended", "Not", "Insufficient"]


def test_outcomes_and_defaults(spark):
    rows = spark.createDataFrame([("Positive ",), ("worsens",), (None,), ("",), ("odd",)], "o string")
    assert [r[0] for r in rows.select(labels.canonical_outcome(F.col("o"))).collect()] == ["improves", "worsens", "no_effect", "no_effect", "no_effect"]
    values = spark.createDataFrame([(0.0,), (None,), (1.7,), (0.4,)], "c double")
    assert [r[0] for r in values.select(labels.default_confidence(F.col("c"))).collect()] == [0.5, 0.5, 1.0, 0.4]


@settings(max_examples=60, deadline=None)
@given(st.text("abc -", max_size=8), st.text("abc -", max_size=8))
def test_edit_ratio_is_symmetric_and_bounded(a, b):
    assert text._ratio(a, b) == text._ratio(b, a)
    assert 0 <= text._ratio(a, b) <= 1 and text._ratio(a, a) == 1


def test_json_repair():
    assert text._repaired("x {\"a\": [1,],} y") == '{"a": [1]}'
    assert text._repaired("{'a': 1}") == '{"a": 1}' and text._repaired("none") is None and text._repaired(None) is None


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 60), st.floats(0.01, 0.99))
def test_beta_quantile_inverts_binomial_tail(a, b, p):
    x = float(scoring.beta_quantiles(np.array([p]), np.array([float(a)]), np.array([float(b)]))[0])
    n = a + b - 1  # the incomplete beta of whole numbers is a binomial tail
    tail = sum(math.comb(n, k) * x**k * (1 - x) ** (n - k) for k in range(a, n + 1))
    assert tail == pytest.approx(p, abs=1e-9)


def test_vectors(spark):
    v = F.array(*[F.lit(x) for x in (3.0, 4.0)])
    r = one(spark, vectors.l2_normalise(v), vectors.cosine(v, v), vectors.cosine(v, F.transform(v, lambda x: -x)), vectors.is_valid(v, 2), vectors.is_valid(vectors.l2_normalise(v), 2))
    assert r[0] == pytest.approx([0.6, 0.8]) and r[1] == pytest.approx(1.0) and r[2] == 0.0 and (r[3], r[4]) == (False, True)


def test_profiles(spark):
    p, q = (F.create_map(*[F.lit(x) for x in xs]) for xs in (("a", 0.5, "b", 0.5), ("a", 0.5, "c", 0.5)))
    r = one(spark, similarity.profile_cosine(p, q), similarity.overlap_cosine(p, q, 1), similarity.ratio_similarity(p, q), similarity.profile_cosine(p, p, True), similarity.jaccard(F.array(), F.array()))
    assert r[0] == pytest.approx(0.5) and r[1] == pytest.approx(1.0) and r[2] == 1.0 and 0.9 < r[3] <= 1.0 and r[4] == 1.0
