"""Fact mart: eight trapezoid scores and the weighted total per field x month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SCORE_COLUMNS, SEASONAL_FEATURES, SOIL_FEATURES, WEIGHTS
from ..functions.scoring import mean_of, trapezoid_score, weighted_index
from ..operators.joins import BOUNDS, attach_seasonal_bounds, attach_static_bounds, unique_thresholds

FACT_COLUMNS = (
    "field_id", "date", "agricultural_period", *SEASONAL_FEATURES, *SOIL_FEATURES,
    *SCORE_COLUMNS, "total_suitability_score",
)


def _score(feature: str) -> "F.Column":
    return trapezoid_score(F.col(feature), *[F.col(f"{feature}_{b}") for b in BOUNDS])


def with_bounds(harmonized: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every harmonized row with the bounds of its season (three seasonal
    features) and the static bounds (five soil features) as columns. Several
    rows for one (feature, period) fail the query, for both kinds alike."""
    out, thresholds = harmonized, unique_thresholds(thresholds)
    for f in SEASONAL_FEATURES:
        out = attach_seasonal_bounds(out, thresholds, f)
    return attach_static_bounds(out, thresholds, SOIL_FEATURES)


def scored(harmonized: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Harmonized rows plus the eight ``<feature>_score`` columns."""
    b = with_bounds(harmonized, thresholds)
    return b.select(*harmonized.columns,
                    *[_score(f).alias(f"{f}_score") for f in SEASONAL_FEATURES + SOIL_FEATURES])


def total_score(weights: Sequence[tuple[str, float]] = WEIGHTS) -> "F.Column":
    """temperature*0.4 + rainfall*0.3 + ndvi*0.2 + mean(five soil scores)*0.1
    (weights from the config, added in that order)."""
    terms = []
    for name, w in weights:
        col = mean_of([f"{s}_score" for s in SOIL_FEATURES]) if name == "soil" else F.col(f"{name}_score")
        terms.append((col, w))
    return weighted_index(terms)


def fact_suitability(harmonized: DataFrame, thresholds: DataFrame,
                     weights: Sequence[tuple[str, float]] = WEIGHTS) -> DataFrame:
    """The fact table (20 columns; ``month`` is not carried)."""
    s = scored(harmonized, thresholds)
    return s.select(*FACT_COLUMNS[:-1], total_score(weights).alias("total_suitability_score"))
