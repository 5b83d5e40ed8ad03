"""Digamma function psi(x) for x > 0 (P20), as a Spark Column and in numpy.

Spark has no builtin digamma.  The recurrence psi(x) = psi(x + n) -
sum_{j<n} 1/(x + j) moves the argument to x + n >= n, where the asymptotic
(Stirling) series is accurate to ~1e-12 for n = 6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickfold.functions._util import col

# Recurrence shift and the asymptotic-series coefficients
# c_k of psi(y) ~ ln y - 1/(2y) - sum_k c_k / y^(2k)  (Bernoulli B_2k / 2k).
SHIFT = 6
SERIES = (1.0 / 12, -1.0 / 120, 1.0 / 252, -1.0 / 240, 1.0 / 132, -691.0 / 32760, 1.0 / 12)


def digamma(x) -> Column:
    """psi(x) as a JVM expression (stays in codegen; no Python UDF)."""
    x = col(x).cast("double")
    y = x + F.lit(float(SHIFT))
    inv2 = F.lit(1.0) / (y * y)
    # Horner form of sum_k c_k * inv2^k.
    series = F.lit(SERIES[-1])
    for c in reversed(SERIES[:-1]):
        series = F.lit(c) + inv2 * series
    series = inv2 * series
    shift = F.lit(0.0)
    for j in range(SHIFT):
        shift = shift + F.lit(1.0) / (x + F.lit(float(j)))
    return F.ln(y) - F.lit(0.5) / y - series - shift
