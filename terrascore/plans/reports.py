"""Reports over the marts: spatial distribution, factor breakdown, seasonal
trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SOIL_FEATURES, WEIGHTS
from ..functions.dates import year_of
from ..functions.exact import exact_mean
from ..functions.scoring import mean_of


def report_spatial(fact: DataFrame, location: DataFrame, cell_deg: float = 1.0) -> DataFrame:
    """Average total score per ``cell_deg`` grid cell of field locations.

    Each field is first reduced to its mean total (partial aggregation on the
    fact), then placed in its cell; the cell average is the mean of its field
    means. Fields without a location are not placed."""
    per_field = fact.groupBy("field_id").agg(exact_mean(F.col("total_suitability_score")).alias("field_score"))
    c = float(cell_deg)
    placed = per_field.join(location.select("field_id", "latitude", "longitude"), "field_id", "inner")
    cells = placed.select(
        F.floor(F.col("latitude") / c).alias("cell_lat"), F.floor(F.col("longitude") / c).alias("cell_lon"),
        "field_id", "field_score",
    )
    return cells.groupBy("cell_lat", "cell_lon").agg(
        F.count(F.lit(1)).alias("n_fields"), exact_mean(F.col("field_score")).alias("avg_total_score"),
        F.min("field_score").alias("min_field_score"), F.max("field_score").alias("max_field_score"),
    )


def report_factors(fact: DataFrame) -> DataFrame:
    """Per season and factor: mean score and mean weighted contribution to the
    total (the four weighted terms add up to the total)."""
    terms = []
    for name, w in WEIGHTS:
        score = mean_of([f"{s}_score" for s in SOIL_FEATURES]) if name == "soil" else F.col(f"{name}_score")
        terms.append(F.struct(F.lit(name).alias("factor"), score.alias("score"), (score * float(w)).alias("contribution")))
    long = fact.select("agricultural_period", F.explode(F.array(*terms)).alias("t"))
    return long.groupBy("agricultural_period", F.col("t.factor").alias("factor")).agg(
        exact_mean(F.col("t.score")).alias("avg_score"), exact_mean(F.col("t.contribution")).alias("avg_contribution")
    )


def report_trends(fact: DataFrame) -> DataFrame:
    """Environmental metrics per year and growth stage. The year is the one
    the date dimension holds for the date; it comes from the date itself, so the
    fact is read once and rows without a date keep a row of their own (null year)."""
    return fact.groupBy(year_of("date").alias("year"), "agricultural_period").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[exact_mean(F.col(c)).alias(out) for c, out in (("ndvi", "avg_ndvi"), ("temperature", "avg_temperature"),
                                                         ("rainfall", "avg_rainfall"), ("total_suitability_score", "avg_total_score"))],
    )
