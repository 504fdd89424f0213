"""Expressions on probabilities and counts: log odds, prior re-basing, severity ladders, novelty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def logit(p: Column, eps: float = EPS) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.log(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))


def rebase(p: Column, train_prior: float, deploy_prior: float) -> Column:
    """A posterior learned at one class prior, at another one: odds shift with the prior odds."""
    return sigmoid(logit(p) + logit(F.lit(deploy_prior)) - logit(F.lit(train_prior)))


def rebase_inverse(p: Column, train_prior: float, deploy_prior: float) -> Column:
    """The raw score that `rebase` turns into p."""
    return rebase(p, deploy_prior, train_prior)


def severity(p: Column, critical: float, high: float, medium: float) -> Column:
    return F.when(p >= critical, "Critical").when(p >= high, "High").when(p >= medium, "Medium").otherwise("Low")


def spike_severity(n: Column, critical: int = 500, high: int = 200) -> Column:
    return F.when(n >= critical, "Critical").when(n >= high, "High").otherwise("Medium")


def above(p: Column, cut: float) -> Column:
    """The gate: at or above the cut; null and NaN never pass."""
    return F.coalesce(~F.isnan(p) & (p >= cut), F.lit(False))


def safe_prefilter(cut: float, most_shift: float = 1.5) -> Column:
    """The loosest cut that drops nothing which a shift of at most `most_shift` log odds could lift over `cut`."""
    return sigmoid(logit(F.lit(cut)) - most_shift)


def score_bin(p: Column, bins: int = 20) -> Column:
    """Number of the fixed bin of a score in [0, 1]; 1 falls into the last."""
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(p * bins).cast("int")))


def novelty(density: Column, least: float = 1e-3, most: float = 5.0) -> Column:
    return clip(F.log(1 / F.greatest(density, F.lit(least))), 0.0, most)
