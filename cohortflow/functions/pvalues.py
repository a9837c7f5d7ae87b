"""p-values of the two-sample tests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortflow.functions.scalars import erfc

# Below this argument the Kolmogorov tail is 1 to twelve digits.
KOLMOGOROV_ONE_BELOW = 0.2
KOLMOGOROV_TERMS = 100


def kolmogorov_tail(x: Column) -> Column:
    """Q(x) = 2 * sum over k of (-1)^(k-1) exp(-2 k^2 x^2), kept within [0, 1]."""

    def add_term(total: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        return total + sign * F.exp(F.lit(-2.0) * k * k * x * x)

    steps = F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS))
    series = F.lit(2.0) * F.aggregate(steps, F.lit(0.0), add_term)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    return F.when(x < KOLMOGOROV_ONE_BELOW, F.lit(1.0)).otherwise(bounded)


def ks_p_value(distance: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sample p-value with Stephens' small-sample argument."""
    root = F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    return kolmogorov_tail((root + 0.12 + F.lit(0.11) / root) * distance)


def two_sided_normal_p(z: Column) -> Column:
    return F.least(F.lit(1.0), erfc(F.greatest(z, F.lit(0.0)) / F.sqrt(F.lit(2.0))))
