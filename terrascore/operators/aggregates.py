"""Aggregation operators: per field x season averages and the season pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEASONS
from ..functions.exact import exact_mean

FIELD_SEASON_MEASURES = (
    ("ndvi", "avg_ndvi"),
    ("temperature", "avg_temperature"),
    ("rainfall", "avg_rainfall"),
    ("ndvi_score", "avg_ndvi_score"),
    ("temperature_score", "avg_temperature_score"),
    ("rainfall_score", "avg_rainfall_score"),
    ("total_suitability_score", "avg_total_suitability_score"),
)

# (source column, output prefix) of the 12 pivoted columns, in output order.
PIVOT_MEASURES = (
    ("ndvi_score", "ndvi_score"),
    ("temperature_score", "temp_score"),
    ("rainfall_score", "rainfall_score"),
    ("total_suitability_score", "total_score"),
)


def field_season_averages(fact: DataFrame) -> DataFrame:
    """Average of measures and scores per field and season (``other_period``
    included). avg ignores nulls. Partial aggregation runs before the shuffle,
    so a field holding most rows costs one partial row per map task."""
    return fact.groupBy("field_id", "agricultural_period").agg(
        *[exact_mean(F.col(src)).alias(out) for src, out in FIELD_SEASON_MEASURES]
    )


def pivot_columns(period_col: str, measures: Sequence[tuple[str, str]], seasons: Sequence[str] = SEASONS):
    """``avg(CASE WHEN period = s THEN m END) AS <prefix>_<s>`` for every
    measure and season, in output order."""
    return [
        exact_mean(F.when(F.col(period_col) == s, F.col(src))).alias(f"{prefix}_{s}")
        for src, prefix in measures
        for s in seasons
    ]


def pivot_seasons(field_season: DataFrame) -> DataFrame:
    """One row per field with the 12 ``<factor>_score_<season>`` columns from
    the per-season averages. A field seen only in ``other_period`` keeps a
    row of nulls."""
    measures = [(f"avg_{src}", prefix) for src, prefix in PIVOT_MEASURES]
    return field_season.groupBy("field_id").agg(*pivot_columns("agricultural_period", measures))


def pivot_seasons_direct(fact: DataFrame) -> DataFrame:
    """Same 12 columns straight from the fact rows in ONE aggregate.

    Exact rewrite: the per-season table has one row per (field, season), so
    the outer average picks that single value, which is the average of the
    fact rows of that season — i.e. ``avg(CASE WHEN season = s THEN score END)``
    over the fact rows of the field. Scores are never null, so the counts
    agree too. One shuffle instead of two."""
    return fact.groupBy("field_id").agg(*pivot_columns("agricultural_period", PIVOT_MEASURES))
