"""Guarded arithmetic shared by the feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickfold.functions._util import col

# Zero-denominator sentinel and log-loss clip bound.
ZERO_DENOMINATOR = -1.0
CLIP_EPSILON = 1e-15


def guarded_ratio(num, den) -> Column:
    """x / y as double; -1 when y == 0; NULL stays NULL.

    ``try_divide`` keeps ANSI mode from raising on a zero denominator; the
    explicit branch decides what a zero means.
    """
    num, den = col(num), col(den)
    return (F.when(den == 0, F.lit(ZERO_DENOMINATOR))
            .otherwise(F.try_divide(num.cast("double"), den.cast("double"))))


def complement(total, part) -> Column:
    """total - part (P12), e.g. count - buy_count."""
    return col(total) - col(part)


def clip_probability(p, eps: float = CLIP_EPSILON) -> Column:
    """Clip a probability into [eps, 1 - eps]."""
    return F.least(F.greatest(col(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))


def log_loss_term(y, p, eps: float = CLIP_EPSILON) -> Column:
    """y*ln(p) + (1-y)*ln(1-p) on the clipped probability (summand of M5)."""
    q = clip_probability(p, eps)
    yd = col(y).cast("double")
    return yd * F.ln(q) + (F.lit(1.0) - yd) * F.ln(F.lit(1.0) - q)
