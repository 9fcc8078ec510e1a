"""Intermediate layer: one row per field x month with the three series, the
season label and the field's soil properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SOIL_FEATURES
from ..functions.dates import month_of
from ..functions.scoring import season_label
from ..operators.joins import full_outer_chain

KEYS = ("field_id", "date")
HARMONIZED_COLUMNS = (
    "field_id", "date", "month", "agricultural_period", "ndvi", "temperature", "rainfall",
    *SOIL_FEATURES,
)


def series_by_month(ndvi: DataFrame, temperature: DataFrame, rainfall: DataFrame) -> DataFrame:
    """ndvi FULL JOIN temperature FULL JOIN rainfall on (field_id, date),
    the second join on the coalesced keys. ``month`` and the season come from
    the coalesced date (the month is null exactly when the date is)."""
    joined = full_outer_chain(
        [ndvi.select(*KEYS, "ndvi"), temperature.select(*KEYS, "temperature"),
         rainfall.select(*KEYS, "rainfall")],
        KEYS,
    )
    month = month_of("date")
    return joined.select(
        "field_id", "date", month.alias("month"), "ndvi", "temperature", "rainfall",
        season_label(month).alias("agricultural_period"),
    )


def series_by_month_unique(ndvi: DataFrame, temperature: DataFrame, rainfall: DataFrame) -> DataFrame:
    """Same rows as :func:`series_by_month` when every series has at most one row
    per non-null (field_id, date) — e.g. series produced by the zonal jobs of
    one polygon set with unique ids. One shuffle (union + group) instead of a
    chain of sort-merge joins. Rows with a null key never merge: they pass
    through ungrouped, as in the join. The inputs are read by both branches:
    meant for stored raw tables, where the null-key branch is pruned by the
    Parquet null-count statistics; on computed inputs prefer the join form."""
    tagged = [
        ndvi.select(*KEYS, F.col("ndvi"), F.lit(None).cast("double").alias("temperature"),
                    F.lit(None).cast("double").alias("rainfall")),
        temperature.select(*KEYS, F.lit(None).cast("double").alias("ndvi"), F.col("temperature"),
                           F.lit(None).cast("double").alias("rainfall")),
        rainfall.select(*KEYS, F.lit(None).cast("double").alias("ndvi"),
                        F.lit(None).cast("double").alias("temperature"), F.col("rainfall")),
    ]
    allrows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    keyed = allrows.filter(F.col("field_id").isNotNull() & F.col("date").isNotNull())
    loose = allrows.filter(F.col("field_id").isNull() | F.col("date").isNull())
    merged = keyed.groupBy(*KEYS).agg(F.max("ndvi").alias("ndvi"), F.max("temperature").alias("temperature"),
                                      F.max("rainfall").alias("rainfall"))
    joined = merged.unionByName(loose)
    month = month_of("date")
    return joined.select(
        "field_id", "date", month.alias("month"), "ndvi", "temperature", "rainfall",
        season_label(month).alias("agricultural_period"),
    )


def harmonize(ndvi: DataFrame, temperature: DataFrame, rainfall: DataFrame, soil: DataFrame,
              unique_keys: bool = False) -> DataFrame:
    """The harmonized table. Soil is LEFT joined on field_id: fields with soil
    but no series are not kept; fields without soil keep null soil columns.
    The soil side is one row per field; AQE broadcasts it when its runtime
    size is under the broadcast threshold and sort-merges it otherwise."""
    md = (series_by_month_unique if unique_keys else series_by_month)(ndvi, temperature, rainfall)
    s = soil.select("field_id", *SOIL_FEATURES)
    return md.join(s, "field_id", "left").select(*HARMONIZED_COLUMNS)
