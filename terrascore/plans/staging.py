"""Staging: typed projections of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_lenient, parse_date_strict

SOIL_COLUMNS = ("field_id", "lat", "lon", "soil_ph", "soil_cec", "clay", "silt", "sand")


def stg_series(raw: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """``field_id, date (date), <name>`` from a raw series with text dates.
    Bad date text fails the query unless ``strict=False``."""
    parse = parse_date_strict if strict else parse_date_lenient
    return raw.select("field_id", parse("date").alias("date"), F.col(name))


def stg_ndvi(raw: DataFrame, strict: bool = True) -> DataFrame:
    return stg_series(raw, "ndvi", strict)


def stg_temperature(raw: DataFrame, strict: bool = True) -> DataFrame:
    return stg_series(raw, "temperature", strict)


def stg_rainfall(raw: DataFrame, strict: bool = True) -> DataFrame:
    return stg_series(raw, "rainfall", strict)


def stg_soil(raw: DataFrame) -> DataFrame:
    return raw.select(*SOIL_COLUMNS)


def view_sql(name: str, table: str) -> str:
    """The staging projection as the text of a stored view."""
    if name == "soil":
        return f"SELECT {', '.join(SOIL_COLUMNS)} FROM {table}"
    return f"SELECT field_id, to_date(date, 'yyyy-MM-dd') AS date, {name} FROM {table}"
