"""Scalar training math as Column expressions (DOUBLE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
LOSS_CAP = 30.0              # each log-loss term is capped at 30
NOISE_POWER = 0.75           # unigram^0.75 noise distribution
NOISE_TABLE_SIZE = 1_000_000 # slots of the noise table


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def positive_loss(score: Column) -> Column:
    """-max(ln sigma(s), -30) computed stably as min(log1p(exp(-s)), 30)."""
    return F.least(F.lit(LOSS_CAP), softplus(-score))


def negative_loss(score: Column) -> Column:
    """-max(ln(1 - sigma(s)), -30) = min(log1p(exp(s)), 30)."""
    return F.least(F.lit(LOSS_CAP), softplus(score))


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def linear_decay(lr0: float, lr_min: float, progress: Column) -> Column:
    return F.greatest(F.lit(lr_min), F.lit(lr0) - F.lit(lr0 - lr_min) * progress)


def keep_probability(cnt: Column, total_tokens: Column, threshold: float) -> Column:
    """min(1, sqrt(t/f) + t/f) with f = cnt / total_tokens."""
    r = F.lit(float(threshold)) / (cnt.cast("double") / total_tokens.cast("double"))
    return F.least(F.lit(1.0), F.sqrt(r) + r)
