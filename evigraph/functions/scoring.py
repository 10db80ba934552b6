"""Scores: Beta posteriors, confidences, intervals, decay, lift."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def py_round(col: Column, digits: int) -> Column:
    """Half to even, as the reference language rounds; for labels and reports only."""
    return F.bround(col, digits)


def posterior_mean(positive: Column, negative: Column, a0: float = 1.0, b0: float = 1.0) -> Column:
    """Mean of Beta(a0 + positive, b0 + negative); one half without relevant evidence."""
    return F.when(positive + negative == 0, 0.5).otherwise((positive + a0) / (positive + negative + (a0 + b0)))


def posterior_variance(positive: Column, negative: Column, a0: float = 1.0, b0: float = 1.0) -> Column:
    a, b = positive + a0, negative + b0
    return a * b / ((a + b) * (a + b) * (a + b + 1))


def posterior_confidence(positive: Column, negative: Column, a0: float = 1.0, b0: float = 1.0, target: int = 100) -> Column:
    """Root of the volume's share (logarithmic, up to ``target``) times one less ten variances."""
    n = positive + negative
    volume = F.least(F.lit(1.0), F.log1p(n.cast("double")) / math.log1p(target))
    sure = F.lit(1.0) - F.least(posterior_variance(positive, negative, a0, b0) * 10, F.lit(1.0))
    return F.when(n == 0, 0.0).otherwise(F.sqrt(volume * sure))


def bayes_factor(positive: Column, negative: Column, a0: float = 1.0, b0: float = 1.0) -> Column:
    odds = (positive + a0) / (negative + b0) / (a0 / b0)
    return F.when(positive + negative == 0, 1.0).otherwise(F.least(odds, F.lit(100.0)))


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction (modified Lentz), vectorised."""
    flip = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    gamma = np.vectorize(math.lgamma)
    t_safe = np.clip(t, 1e-300, 1 - 1e-16)
    front = np.exp(gamma(p + q) - gamma(p) - gamma(q) + p * np.log(t_safe) + q * np.log1p(-t_safe)) / p
    tiny = 1e-300
    c, d = np.ones_like(t), 1 - (p + q) * t / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for numerator in (m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + numerator * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + numerator / np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    value = np.where(t <= 0, 0.0, front * h)
    return np.where(flip, 1 - value, value)


def beta_quantiles(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Quantiles by bisection of the incomplete beta."""
    low, high = np.zeros(len(p)), np.ones(len(p))
    for _ in range(60):
        mid = (low + high) / 2
        below = _incomplete_beta(a, b, mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


@F.pandas_udf(DoubleType())
def beta_quantile(p: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    """No built-in inverts the incomplete beta."""
    return pd.Series(beta_quantiles(p.to_numpy(float), a.to_numpy(float), b.to_numpy(float)))


def conservative_score(positive: Column, negative: Column, a0: float = 1.0, b0: float = 1.0) -> Column:
    """The posterior's 10% quantile; one half without relevant evidence."""
    q = beta_quantile(F.lit(0.1), (positive + a0).cast("double"), (negative + b0).cast("double"))
    return F.when(positive + negative == 0, 0.5).otherwise(q)


def clopper_pearson(successes: Column, trials: Column, level: float = 0.95) -> tuple[Column, Column]:
    half = (1 - level) / 2
    k, n = successes.cast("double"), trials.cast("double")
    # arguments are kept in the quantile's domain where another branch is taken
    low = beta_quantile(F.lit(half), F.greatest(k, F.lit(1.0)), F.greatest(n - k + 1, F.lit(1.0)))
    high = beta_quantile(F.lit(1 - half), k + 1, F.greatest(n - k, F.lit(1.0)))
    return F.when((trials == 0) | (successes == 0), 0.0).otherwise(low), F.when((trials == 0) | (successes == trials), 1.0).otherwise(high)


def ratio_score(positive: Column, total: Column) -> tuple[Column, Column]:
    none = total == 0
    return F.when(none, 0.5).otherwise(positive / total), F.when(none, 0.0).otherwise(F.least(F.lit(1.0), F.log1p(total.cast("double")) / math.log(100)))


def wilson_score(positive: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Centre of the Wilson interval, and one less the root of its spread."""
    p, n = positive / total, total
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    spread = F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(total == 0, 0.5).otherwise(centre), F.when(total == 0, 0.0).otherwise(1 - spread)


def laplace_score(positive: Column, total: Column) -> tuple[Column, Column]:
    return F.when(total == 0, 0.5).otherwise((positive + 1) / (total + 2)), F.when(total == 0, 0.0).otherwise(1 - F.lit(2.0) / (total + 2))


def sample_confidence(n: Column, target: int = 100, method: str = "logarithmic") -> Column:
    share = {"logarithmic": F.log1p(n.cast("double")) / math.log1p(target), "linear": n / target, "sqrt": F.sqrt(n / target)}[method]
    return F.when(n <= 0, 0.0).otherwise(F.least(F.lit(1.0), share))


def variance_confidence(variance: Column, n: Column, most: float = 0.25) -> Column:
    return F.when(n < 2, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - variance / most))


def consensus_confidence(agree: Column, total: Column, threshold: float = 0.7) -> Column:
    """0.7 at the threshold, straight lines to 0 and to 1."""
    share = agree / total
    return F.when(total == 0, 0.0).when(share >= threshold, 0.7 + 0.3 * (share - threshold) / (1 - threshold)).otherwise(0.7 * share / threshold)


def decay(value: Column, years: Column, half_life: float) -> Column:
    """Halves with each half life; years are held to 0 to 100."""
    return value * F.pow(F.lit(0.5), F.greatest(F.lit(0), F.least(F.lit(100), years)) / half_life)


def lift(observed: Column, expected: Column) -> Column:
    return F.when(expected == 0, F.when(observed == 0, 0.0).otherwise(F.lit(float("inf")))).otherwise(observed / expected)


def weighted_mean(values: list[Column], weights: list[float]) -> Column:
    """Mean of the values that are present, held to 0 to 1; 0 where none is."""
    top = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in zip(values, weights, strict=True)), F.lit(0.0))
    bottom = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in zip(values, weights, strict=True)), F.lit(0.0))
    return F.when(bottom == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), top / bottom)))


def agreement_boost(confidence: Column, models: Column) -> Column:
    return F.least(F.lit(0.98), confidence + 0.05 * (models - 1))


def effective_confidence(*chain: Column) -> Column:
    return F.coalesce(*chain, F.lit(0.5))


def edge_confidence(weight: Column, n_sources: Column, recency: Column, controversy: Column, mean_weight: Column) -> Column:
    """An edge's weight by its sources, recency, controversy and standing; a null factor is left out."""
    sources = 0.7 + 0.3 * F.least(F.lit(1.0), F.log1p(n_sources.cast("double")) / math.log(10))
    out = weight
    for factor in (sources, 0.8 + 0.2 * recency, 1.0 - 0.3 * controversy, F.least(F.lit(1.5), weight / mean_weight)):
        out = out * F.coalesce(factor, F.lit(1.0))
    return F.least(F.lit(1.0), out)
