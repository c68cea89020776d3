"""Logistic scores and guarded ratios."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_predictor(intercept: float, coefficients: Mapping[str, float]) -> Column:
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.col(name) * float(weight)
    return total


def logistic(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


STEPS = 4_000  # even
REACH = 40.0


def correlation_tails(rho: Column, n: Column) -> Column:
    """Two-sided probability of a correlation of ``n`` pairs by Student's t with n - 2 degrees of freedom; n above 2.

    With t as the tangent of an angle both the tail and the whole are integrals
    of a power of the cosine, from the arc sine of the correlation and from 0
    to a right angle. Angles are scaled by the root of the degrees of freedom,
    beyond ``REACH`` of which nothing is left that a double could show; each is
    summed by Simpson's rule.
    """
    power = (n - 3).cast("double")
    scale = F.sqrt((n - 2).cast("double"))
    top = F.least(F.lit(REACH), scale * (math.pi / 2))

    def area(start: Column) -> Column:
        step = (top - start) / STEPS

        def height(i: Column) -> Column:
            cosine = F.greatest(F.cos((start + step * i) / scale), F.lit(0.0))
            return F.when(cosine > 0, F.exp(power * F.ln(F.greatest(cosine, F.lit(1e-300))))).otherwise(F.when(power == 0, 1.0).otherwise(0.0))

        def weight(i: Column) -> Column:
            return F.when((i == 0) | (i == STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)

        return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), F.lit(0.0), lambda a, i: a + weight(i) * height(i)) * step

    start = F.asin(F.least(F.abs(rho), F.lit(1.0))) * scale
    return F.when(start >= top, 0.0).otherwise(area(start) / area(F.lit(0.0)))
