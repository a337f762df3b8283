"""Two-sided p-value of a correlation, as a plain column expression.

With a = (n - 2) / 2 the p-value is the regularised incomplete beta function I_x(a, 1/2) at
x = 1 - r^2. Substituting u = x exp(-s/a) in its integral gives

    p = x^a / (a B(a, 1/2)) * integral over s > 0 of exp(-s) / sqrt(r^2 + x (1 - exp(-s/a)))

whose integrand is positive and smooth, so that a fixed trapezoidal rule in t, with
s = exp(t - exp(-t)), reaches double precision for all n and r, far into the tail.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.labels import let

_STEP = 1 / 40
_GRID = [k * _STEP for k in range(-180, 181)]
_NODES = [math.exp(t - math.exp(-t)) for t in _GRID]
_WEIGHTS = [_STEP * s * (1 + math.exp(-t)) * math.exp(-s) for t, s in zip(_GRID, _NODES)]
_SHIFT = 20


def _gamma_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a): asymptotic series at a + 20, carried back by the recurrence."""
    def series(z: Column) -> Column:
        inverse = F.lit(1.0) / z
        tail = inverse * (-1 / 8) + F.pow(inverse, F.lit(3.0)) * (1 / 192) \
            - F.pow(inverse, F.lit(5.0)) * (1 / 640) + F.pow(inverse, F.lit(7.0)) * (17 / 14336)
        return F.sqrt(z) * F.exp(tail)

    steps = F.transform(F.sequence(F.lit(0), F.lit(_SHIFT - 1)), lambda i: i.cast("double"))
    back = F.aggregate(steps, F.lit(1.0), lambda acc, i: acc * ((a + i) / (a + i + 0.5)))
    return series(a + float(_SHIFT)) * back


def p_value(r: Column, n: Column) -> Column:
    """Two-sided p of Pearson's r over n pairs; NULL below three pairs."""
    def value(s: Column) -> Column:
        a, square = s["a"], s["square"]
        rest = F.lit(1.0) - square
        terms = F.zip_with(
            F.lit(_NODES), F.lit(_WEIGHTS),
            lambda node, weight: weight / F.sqrt(square - rest * F.expm1(-node / a)),
        )
        integral = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
        front = F.exp(a * F.log1p(-square)) * _gamma_ratio(a) / (a * math.sqrt(math.pi))
        return F.when(square >= 1.0, F.lit(0.0)).otherwise(F.least(front * integral, F.lit(1.0)))

    inputs = F.struct(((n.cast("double") - 2.0) / 2.0).alias("a"), (r * r).alias("square"))
    return F.when((n >= 3) & r.isNotNull(), let(inputs, value))
