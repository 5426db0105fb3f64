"""Tail probabilities Spark SQL has no function for.

They are applied to finished test results, one row per predictor or coefficient.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_STEPS = 500
FRACTION_STEPS = 300
TAIL_GONE = 1500.0  # from here on the tail is below the least double


def chi_squared_upper(x: float, df: int) -> float:
    """P(X > x) for a chi-squared variable, by the closed sums for whole degrees of freedom.

    Each term is the exponential of its logarithm, so none overflows and large statistics give 0.
    """
    if x is None or df is None or math.isnan(x) or df < 1:
        return math.nan
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    half = x / 2
    odd = df % 2
    first = 0.5 if odd else 0.0
    terms = (math.exp((i + first) * math.log(half) - half - math.lgamma(i + first + 1)) for i in range(df // 2))
    return min(1.0, (math.erfc(math.sqrt(half)) if odd else 0.0) + math.fsum(terms))


def chi_squared_tail(x: Column, df: Column) -> Column:
    """P(X > x) for whole degrees of freedom as a column; NULL without a statistic or degrees of freedom.

    With a = df / 2 and x halved, this is the upper incomplete gamma function over the whole one: up to a + 1 by
    the series of the lower part, beyond by the continued fraction of the upper one, read from its end.
    """
    a, half = df / F.lit(2.0), x / F.lit(2.0)
    # log gamma(a) from gamma(1) = 1 or gamma(1/2) = sqrt(pi), one factor a step
    factors = F.sequence(F.lit(1), F.ceil(a).cast("int") - 1)
    odd = (df % 2) == 1
    start = F.when(odd, F.lit(math.log(math.pi) / 2)).otherwise(F.lit(0.0))
    each = F.aggregate(factors, start, lambda s, i: s + F.log(i - F.when(odd, 0.5).otherwise(0.0)))
    log_gamma = F.when(F.ceil(a) > 1, each).otherwise(start)
    front = F.exp(a * F.log(half) - half - log_gamma)
    none = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] * half / (a + i)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    steps = F.sequence(F.lit(1), F.lit(SERIES_STEPS))
    lower = front / a * F.aggregate(steps, none, add)["total"]
    down = F.sequence(F.lit(FRACTION_STEPS), F.lit(1), F.lit(-1))
    rest = F.aggregate(down, F.lit(0.0), lambda t, i: i * (i - a) / (half + 2 * i + 1 - a - t))
    upper = front / (half + 1 - a - rest)
    found = F.when(half < a + 1, 1 - lower).otherwise(upper)
    return (
        F.when(x.isNull() | df.isNull() | (df < 1) | F.isnan(x), F.lit(None).cast("double"))
        .when(x <= 0, F.lit(1.0))
        .when(half > TAIL_GONE + 2 * a, F.lit(0.0))
        .otherwise(F.least(F.greatest(found, F.lit(0.0)), F.lit(1.0)))
    )


def normal_two_sided(z: float) -> float:
    """P(|Z| > |z|) for a standard normal variable."""
    return math.erfc(abs(z) / math.sqrt(2))
