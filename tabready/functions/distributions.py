"""Student's t distribution as Spark column expressions.

The regularised incomplete beta function comes from its continued fraction,
folded term by term over an array of a fixed length; the quantile from halving
the interval of the logarithm of its argument.  No Python runs for a row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the Lanczos approximation of the gamma function (g = 7, 9 terms).
LANCZOS_G = 7.0
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)

#: Terms of the continued fraction: enough for 1e-12 where it is used, left of
#: the mean, up to about 10^5 degrees of freedom.
TERMS = 250
#: Halvings of the quantile's interval, and its left end as a logarithm.
HALVINGS, LOG_LEAST = 70, -690.0
TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function of a positive number."""
    series = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:]):
        series = series + F.lit(c) / (x + k)
    t = x + (LANCZOS_G - 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (x - 0.5) * F.log(t) - t + F.log(series)


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, evaluated forward."""
    kept = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)
    state = lambda c, d, h: F.struct(c.alias("c"), d.alias("d"), h.alias("h"))
    d0 = 1.0 / kept(1.0 - (a + b) * x / (a + 1.0))

    def step(s: Column, number: Column, term: Column) -> Column:
        d = 1.0 / kept(1.0 + number * s["d"])
        c = kept(1.0 + number / s["c"])
        return state(c, d, s["h"] * c * d)

    def both(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        # the two half steps in turn, so that neither is written out again for each use
        return F.aggregate(F.array(even, odd), s, lambda t, number: step(t, number, m))

    start = state(F.lit(1.0), d0, d0)
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, both, lambda s: s["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b) for 0 <= x <= 1."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1.0 - x))
    left = x < (a + 1.0) / (a + b + 2.0)
    y = F.when(left, x).otherwise(1.0 - x)
    p, q = F.when(left, a).otherwise(b), F.when(left, b).otherwise(a)
    value = front * _fraction(y, p, q) / p
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.when(left, value).otherwise(1.0 - value))


def student_t_tail(t: Column, df: Column) -> Column:
    """P(T > t) with ``df`` degrees of freedom; 0 and 1 at the infinities, null
    for a null or NaN, or without a degree of freedom."""
    df = df.cast("double")
    both = incomplete_beta(df / (df + t * t), df / 2.0, F.lit(0.5))
    tail = F.when(t >= 0, both / 2.0).otherwise(1.0 - both / 2.0)
    inf = F.lit(float("inf"))
    return F.when((df > 0) & ~F.isnan(t), F.when(t == inf, 0.0).when(t == -inf, 1.0).otherwise(tail))


def student_t_quantile(upper: Column, df: Column) -> Column:
    """The t with P(T > t) = ``upper``, for 0 < upper < 1."""
    df, less = df.cast("double"), F.least(upper, 1.0 - upper)
    ends = F.struct(F.lit(LOG_LEAST).alias("lo"), F.lit(0.0).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = (s["lo"] + s["hi"]) / 2.0
        below = incomplete_beta(F.exp(middle), df / 2.0, F.lit(0.5)) < 2.0 * less
        return F.struct(F.when(below, middle).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(middle).alias("hi"))

    log_x = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), ends, halve, lambda s: (s["lo"] + s["hi"]) / 2.0)
    t = F.sqrt(df * F.expm1(-log_x))
    return F.when((df > 0) & (upper > 0) & (upper < 1), F.when(upper < 0.5, t).when(upper > 0.5, -t).otherwise(0.0))
