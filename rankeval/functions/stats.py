"""Column expressions for guarded arithmetic and significance tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIMPSON_STEPS = 2000  # even number of Simpson intervals for the t distribution tail
TAIL = 80.0  # the t density is integrated until it has fallen by exp(-TAIL)


def nan() -> Column:
    return F.lit(float("nan"))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NaN when den is 0 (ANSI mode would raise otherwise)."""
    return F.when(den == 0, nan()).otherwise(num.cast("double") / den.cast("double"))


def _simpson(lower: Column, upper: Column, f) -> Column:
    """Simpson rule for the integral of ``f`` over [lower, upper]."""
    h = (upper - lower) / F.lit(SIMPSON_STEPS)

    def weight(i):
        return F.when((i == 0) | (i == SIMPSON_STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)

    total = F.aggregate(
        F.sequence(F.lit(0), F.lit(SIMPSON_STEPS)),
        F.lit(0.0).cast("double"),
        lambda acc, i: acc + weight(i) * f(lower + i.cast("double") * h),
    )
    return total * h / F.lit(3.0)


def welch_p_value(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t with (fractional, >= 1) ``df`` degrees of freedom.

    The ratio of the density's integral beyond |t| to that over the half line, so no gamma
    function is needed.  With u = sinh(w) the integrand has a width of order one for any
    ``df``, and each integral ends where the density has fallen by exp(-TAIL) from its start:
    the steps follow the peak however large ``df`` is.
    """
    def density(w):  # relative to the start of the window, times du/dw
        u = F.sinh(w)
        return lambda at: F.exp(-(df + 1) / 2 * (F.log1p(u * u / df) - F.log1p(at * at / df))) * F.cosh(w)

    def beyond(at):
        fall = F.lit(2 * TAIL) / (df + 1)
        end = F.sqrt(df * (at * at / df * F.exp(fall) + F.expm1(fall)))
        return _simpson(F.asinh(at), F.asinh(end), lambda w: density(w)(at))

    scale = F.exp(-(df + 1) / 2 * F.log1p(t * t / df))
    return scale * beyond(F.abs(t)) / beyond(F.lit(0.0))


def wilcoxon_normal_p(w_max: Column, n: Column, ties: Column) -> Column:
    """Two-sided p by the normal approximation with tie correction: ``ties`` is the sum of c^3 - c
    over the groups of equal absolute differences."""
    nd = n.cast("double")
    mean = nd * (nd + 1) / 4
    variance = nd * (nd + 1) * (2 * nd + 1) / 24 - ties / 48
    z = (w_max - mean) / F.sqrt(variance)
    return F.when((n <= 0) | (variance <= 0), nan()).otherwise(_normal_two_sided(z))


def _normal_two_sided(z: Column) -> Column:
    """erfc(z / sqrt 2): the normal density's integral beyond ``z`` over that over the half line."""
    def beyond(at):
        return _simpson(F.lit(0.0), F.sqrt(at * at + 2 * TAIL) - at, lambda x: F.exp(-x * (at + x / 2)))

    return F.exp(-z * z / 2) * beyond(z) / beyond(F.lit(0.0))
