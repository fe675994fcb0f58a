"""Scalar statistics as Spark expressions (codegen-friendly, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of the Kolmogorov series and the lambda below which p = 1.
KS_TERMS = 100
KS_SMALL_LAMBDA = 0.2


def ks_pvalue(d: str, n: str, m: str) -> Column:
    """Asymptotic two-sample KS p-value (Kolmogorov series) of the columns named
    ``d`` (statistic), ``n`` and ``m`` (sample sizes).

    lambda = d * sqrt(n m / (n + m));  p = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2),
    clamped to [0, 1]; p = 1 when lambda < 0.2 (the series needs many terms there
    and the true value is 1 to 9 digits).  Built as SQL text (one JVM call).
    """
    lam = f"(`{d}` * sqrt(CAST(`{n}` AS DOUBLE) * CAST(`{m}` AS DOUBLE) / CAST(`{n}` + `{m}` AS DOUBLE)))"
    series = f"aggregate(sequence(1, {KS_TERMS}), 0D, (acc, k) -> acc + 2D * pow(-1D, k - 1) * exp(-2D * k * k * {lam} * {lam}))"
    return F.expr(f"CASE WHEN {lam} < {KS_SMALL_LAMBDA} THEN 1D ELSE least(greatest({series}, 0D), 1D) END")


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    lam = f"({d} * sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m})))"
    series = (
        f"list_reduce(list_transform(range(1, {KS_TERMS + 1}), lambda k: 2.0 * pow(-1.0, k - 1) * exp(-2.0 * k * k * {lam} * {lam})),"
        " lambda a, b: a + b)"
    )
    return f"(CASE WHEN {lam} < {KS_SMALL_LAMBDA} THEN 1.0 ELSE least(greatest({series}, 0.0), 1.0) END)"


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def xlogy_ratio(p: Column, q: Column) -> Column:
    """p * ln(p / q) with 0 * ln 0 = 0."""
    return F.when(p > 0, p * F.log(p / q)).otherwise(F.lit(0.0))
