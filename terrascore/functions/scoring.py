"""Pure Column functions of the suitability model. No UDFs: everything here
compiles into whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import OTHER_PERIOD, SEASON_MONTHS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trapezoid_score(value, optimal_min, optimal_max, acceptable_min, acceptable_max) -> Column:
    """Score a measure against an optimal and an acceptable range.

    First match wins: null value -> 0; inside [optimal_min, optimal_max] -> 1;
    in [acceptable_min, optimal_min) rises linearly from 0.5 to 1; in
    (optimal_max, acceptable_max] falls linearly from 1 to 0.5; else 0.
    Null bounds make every comparison null, so the score is 0. NaN also scores
    0. The divisors are wrapped in nullif so an empty ramp never divides by 0.
    """
    v, omin, omax = _c(value), _c(optimal_min), _c(optimal_max)
    amin, amax = _c(acceptable_min), _c(acceptable_max)
    rising = (v - amin) / F.nullif(omin - amin, F.lit(0.0)) * 0.5 + 0.5
    falling = F.lit(1.0) - ((v - omax) / F.nullif(amax - omax, F.lit(0.0)) * 0.5)
    return (
        F.when(v.isNull(), F.lit(0.0))
        .when(v.between(omin, omax), F.lit(1.0))
        .when((v >= amin) & (v < omin), rising)
        .when((v > omax) & (v <= amax), falling)
        .otherwise(F.lit(0.0))
    )


def season_label(month) -> Column:
    """Growing-season label of a calendar month; null and other months map to
    ``other_period``."""
    m = _c(month)
    expr = None
    for name, months in SEASON_MONTHS:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_PERIOD))


def mean_of(cols: Iterable) -> Column:
    """Arithmetic mean of a fixed list of columns: (a + b + ...) / n."""
    cols = [_c(c) for c in cols]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / len(cols)


def weighted_index(terms: Iterable[tuple]) -> Column:
    """Weighted sum of (column, weight) terms, added left to right."""
    out = None
    for col, w in terms:
        term = _c(col) * float(w)
        out = term if out is None else out + term
    return out
