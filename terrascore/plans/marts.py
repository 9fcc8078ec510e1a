"""Marts: date and location dimensions and the wide per-field dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SOIL_FEATURES
from ..functions.dates import month_of, year_of
from ..functions.scoring import season_label
from ..operators.aggregates import PIVOT_MEASURES, pivot_seasons_direct
from ..config import SEASONS

ASSESSMENT_COLUMNS = (
    "field_id", "latitude", "longitude", *SOIL_FEATURES,
    *[f"{prefix}_{s}" for _, prefix in PIVOT_MEASURES for s in SEASONS],
)


def dim_date(harmonized: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct (date, year, month, agricultural_period), ordered by date.

    year, month and the season are functions of the date in the harmonized
    table (its month is taken from the same coalesced side as its date), so
    only the date is de-duplicated: the shuffle carries one column."""
    dates = harmonized.select("date").distinct()
    out = dates.select(
        "date", year_of("date").alias("year"), month_of("date").alias("month"),
        season_label(month_of("date")).alias("agricultural_period"),
    )
    return out.orderBy("date") if ordered else out


def dim_location(soil: DataFrame) -> DataFrame:
    """One row per soil row, lat/lon renamed."""
    return soil.select(
        "field_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), *SOIL_FEATURES
    )


def assessment_dataset(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Per field: location, soil and the 12 season-pivoted score averages.

    The per-season average and the pivot are fused into one aggregate (exact,
    see ``pivot_seasons_direct``), then LEFT joined to the location dimension.
    The aggregate's output is hash-partitioned on field_id, so a sort-merge
    join reuses it and only the location side moves."""
    pivoted = pivot_seasons_direct(fact)
    return pivoted.join(location, "field_id", "left").select(*ASSESSMENT_COLUMNS)
