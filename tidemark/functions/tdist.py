"""Student-t distribution function as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def student_t_cdf(t: Column, v: Column, steps: int = 1000) -> Column:
    """P(T <= t) with ``v`` degrees of freedom (whole number, at least 1).

    With t = sqrt(v) tan(u) the density becomes cos(u)^(v-1), which Simpson's rule
    integrates to about 1e-9; the mass beyond 12 standard units is left out. The
    constant factor cancels against the integral over the whole range. ``steps``
    must be even. Meant for result tables, not for raw rows.
    """
    top = F.least(F.lit(math.pi / 2), F.lit(12.0) / F.sqrt(v))
    angle = F.least(F.atan(F.abs(t) / F.sqrt(v)), top)

    def area(limit: Column) -> Column:
        h = limit / F.lit(float(steps))

        def add(acc: Column, i: Column) -> Column:
            weight = F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            return acc + weight * F.pow(F.greatest(F.cos(i * h), F.lit(0.0)), v - 1)

        return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), add) * h / F.lit(3.0)

    half = F.lit(0.5) * area(angle) / area(top)
    return F.when(t.isNull() | v.isNull() | (v < 1), F.lit(None).cast("double")).otherwise(
        F.lit(0.5) + F.signum(t) * half
    )


def two_sided_p(t: Column, v: Column) -> Column:
    return F.lit(2.0) * (F.lit(1.0) - student_t_cdf(F.abs(t), v))
