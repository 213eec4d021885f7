"""Distribution functions Spark has no built-in for."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Polynomial 7.1.26 of Abramowitz and Stegun for erf.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc_abs(x: Column) -> Column:
    """``erfc(|x|)``, absolute error below 1.5e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * F.abs(x))
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + F.lit(a)) * t
    return poly * F.exp(-x * x)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) of the standard normal."""
    return erfc_abs(z / F.lit(math.sqrt(2.0)))


def normal_cdf(z: Column) -> Column:
    tail = normal_two_sided(z) / F.lit(2.0)
    return F.when(z >= 0, F.lit(1.0) - tail).otherwise(tail)


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _log_gamma_half_step(x: Column) -> Column:
    """``log(gamma(x + 1/2) / gamma(x))`` for positive ``x``, by its series at ``x + 8``.

    The ratio is taken as one series, since a difference of two large
    logarithms would lose its digits for large ``x``.
    """
    s = x + F.lit(8.0)
    back = F.lit(0.0)
    for k in range(8):
        back = back + F.log1p(F.lit(0.5) / (x + F.lit(float(k))))
    r = F.lit(1.0) / s
    cube = r * r * r
    series = r / 8.0 - cube / 192.0 + cube * r * r / 640.0 - cube * cube * r * (17.0 / 14336.0)
    return F.log(s) / 2.0 - series - back


# Points of the quadrature, and the exponent at which the tail is cut off.
TAIL_POINTS = 64
TAIL_EXPONENT = 40.0


def student_t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) with ``df`` degrees of freedom; NULL unless ``df > 0``.

    With ``w = sqrt(df log(1 + u^2 / df))`` for ``u`` the density becomes a normal one
    times ``sqrt(y / (1 - exp(-y)))``, ``y = w^2 / df``, which is smooth for any
    number of degrees of freedom. The tail is integrated over ``w`` by
    Gauss-Legendre quadrature: one method for samples of all sizes.

    It takes some hundred steps per row, so this is meant for rows that are
    already aggregated, one per comparison.
    """
    t, df = F.abs(t), df.cast("double")
    start = F.sqrt(df * F.log1p(t * t / df))
    # The density at the end of this stretch is exp(-TAIL_EXPONENT) of that at its start.
    length = F.lit(2.0 * TAIL_EXPONENT) / (start + F.sqrt(start * start + F.lit(2.0 * TAIL_EXPONENT)))
    nodes, weights = np.polynomial.legendre.leggauss(TAIL_POINTS)
    points = F.array(
        *[F.struct(F.lit((1.0 + float(x)) / 2.0).alias("x"), F.lit(float(w) / 2.0).alias("w")) for x, w in zip(nodes, weights)]
    )

    def height(step: Column) -> Column:
        w = start + step
        y = w * w / df
        bend = F.when(y == 0, F.lit(1.0)).otherwise(F.sqrt(y / -F.expm1(-y)))
        return F.exp(-step * (start + step / 2.0)) * bend

    area = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p["w"] * height(length * p["x"]))
    scale = F.exp(_log_gamma_half_step(df / 2.0) - start * start / 2.0) / F.sqrt(df * F.lit(math.pi))
    return (
        F.when(~(df > 0) | t.isNull(), F.lit(None))
        .when(t == 0, F.lit(1.0))
        .when(start == F.lit(math.inf), F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), F.lit(2.0) * scale * length * area))
    )
