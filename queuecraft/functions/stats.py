"""Closed-form statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 100
SMALL_LAMBDA = 0.2    # below it the truncated series is unstable and the value is 1 anyway


def ks_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov distance.

    The exact small-sample law is not built; the two agree closely from a few dozen rows on.
    """
    size = n.cast("double") * m.cast("double") / (n + m)
    lam = F.sqrt(size) * distance
    k = lambda i: i.cast("double")
    sign = lambda i: F.when(i % 2 == 1, 1.0).otherwise(-1.0)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.lit(0.0),
                        lambda acc, i: acc + sign(i) * F.exp(-2.0 * k(i) * k(i) * lam * lam))
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total))
    return F.when(lam < SMALL_LAMBDA, 1.0).otherwise(p)
