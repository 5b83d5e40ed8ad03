"""Beta-Binomial smoothing of conversion rates.

Fit: Minka's fixed point for Beta(alpha, beta) from per-entity
(impressions, clicks):

    alpha' = alpha * sum_i[psi(c_i + alpha) - psi(alpha)] / D
    beta'  = beta  * sum_i[psi(m_i - c_i + beta) - psi(beta)] / D
    D      = sum_i[psi(m_i + alpha + beta) - psi(alpha + beta)]

The three sums are separable by column, so Spark first reduces the entity
table to three value histograms ``(which, value) -> n`` in one shuffle with
map-side combine.  For integer counts a histogram has at most
sqrt(2 * total) distinct values.  All steps then run as one expression over
the histograms (a fold over the step numbers, with digamma as a Column), so
there is one path for every size and no loop of jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfold.functions.digamma import digamma

# Histogram tags: clicks, non-clicks, impressions.
CLK, NON, IMP = "c", "n", "m"


@dataclass(frozen=True)
class SmoothingFit:
    alpha: float
    beta: float
    steps: int          # fixed-point steps accepted
    converged: bool

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.alpha, self.beta, self.steps, self.converged)],
                                     "alpha double, beta double, steps int, converged boolean")


def rate_counts(df: DataFrame, keys, label: str = "is_trade") -> DataFrame:
    """Per entity: ``imp`` = rows, ``clk`` = positive labels."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("imp"),
                   F.sum(F.col(label).cast("long")).alias("clk")))


def value_histograms(counts: DataFrame, imp: str = "imp", clk: str = "clk") -> DataFrame:
    """``(which, value, n)`` for clicks, non-clicks and impressions."""
    m, c = F.col(imp).cast("double"), F.col(clk).cast("double")
    tagged = counts.select(F.explode(F.array(
        F.struct(F.lit(CLK).alias("which"), c.alias("value")),
        F.struct(F.lit(NON).alias("which"), (m - c).alias("value")),
        F.struct(F.lit(IMP).alias("which"), m.alias("value")),
    )).alias("h")).select("h.which", "h.value")
    return tagged.groupBy("which", "value").agg(F.count(F.lit(1)).alias("n"))


def _gain(hist: Column, base: Column) -> Column:
    """sum over a histogram of n * (psi(value + base) - psi(base)).

    The one-element transform binds psi(base), so that it is computed once."""
    return F.get(F.transform(F.array(digamma(base)), lambda psi: F.aggregate(
        hist, F.lit(0.0), lambda acc, h: acc + h["n"] * (digamma(h["value"] + base) - psi))), F.lit(0))


def fit_smoothing(counts: DataFrame, alpha: float = 1.0, beta: float = 1.0,
                  iter_num: int = 1000, epsilon: float = 1e-10, imp: str = "imp",
                  clk: str = "clk") -> SmoothingFit:
    """Iterate the fixed point (B1) until both moves are below ``epsilon``
    or ``iter_num`` steps (B2).  As in the reference, the step that meets the
    tolerance is discarded: the returned values are the last accepted ones.
    Without entities, the start is returned.
    """
    hist = value_histograms(counts, imp, clk)
    entry = F.struct(F.col("value"), F.col("n").cast("double").alias("n"))
    one = hist.agg(*[F.sort_array(F.collect_list(F.when(F.col("which") == w, entry))).alias(w)
                     for w in (CLK, NON, IMP)])

    def state(a, b, steps, converged, done) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), steps.cast("int").alias("steps"),
                        converged.alias("converged"), done.alias("done"))

    def step(s: Column) -> Column:
        a, b = s["a"], s["b"]
        sums = F.struct(_gain(F.col(CLK), a).alias("c"), _gain(F.col(NON), b).alias("n"),
                        _gain(F.col(IMP), a + b).alias("m"))
        moved = F.transform(F.array(sums), lambda x: F.struct(
            F.try_divide(a * x["c"], x["m"]).alias("a"), F.try_divide(b * x["n"], x["m"]).alias("b")))

        def accept(to: Column) -> Column:
            near = (F.abs(to["a"] - a) < epsilon) & (F.abs(to["b"] - b) < epsilon)
            stop = F.coalesce(near, F.lit(True))    # no entities: nothing to move
            return F.when(stop, state(a, b, s["steps"], F.coalesce(near, F.lit(False)), F.lit(True))
                          ).otherwise(state(to["a"], to["b"], s["steps"] + 1, F.lit(False), F.lit(False)))

        return F.get(F.transform(moved, accept), F.lit(0))

    start = state(F.lit(float(alpha)), F.lit(float(beta)), F.lit(0), F.lit(False), F.lit(False))
    steps = F.sequence(F.lit(1), F.lit(iter_num)) if iter_num > 0 else F.array().cast("array<int>")
    r = one.select(F.aggregate(steps, start, lambda s, _: F.when(s["done"], s).otherwise(step(s)))
                   .alias("s")).first()["s"]
    return SmoothingFit(r["a"], r["b"], r["steps"], r["converged"])


def smoothed_rate(counts: DataFrame, fit: SmoothingFit, imp: str = "imp", clk: str = "clk",
                  out: str = "smoothed_rate") -> DataFrame:
    """(clk + alpha) / (imp + alpha + beta) per entity."""
    a, b = F.lit(fit.alpha), F.lit(fit.beta)
    return counts.withColumn(out, (F.col(clk).cast("double") + a)
                             / (F.col(imp).cast("double") + a + b))
