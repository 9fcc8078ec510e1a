"""Raster operators on the long pixel table
``(image_date, band, ix, iy, lon, lat, value)``.

An image collection is the set of rows of one band; a month's composite is a
per-pixel reduction of the rows of that month. All months run in one pass:
the month is a grouping key, not a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import format_iso, month_starts_between
from ..functions.exact import exact_mean, exact_sum

PIXEL_KEYS = ("ix", "iy")


def reducer(kind: str, value: str = "value", weight: str | None = None):
    """mean / sum, optionally weighted by a per-pixel coverage column."""
    v = F.col(value)
    if weight is None:
        return exact_mean(v) if kind == "mean" else exact_sum(v)
    w = F.col(weight)
    if kind == "sum":
        return exact_sum(v * w)
    return exact_sum(v * w) / F.nullif(exact_sum(F.when(v.isNotNull(), w)), F.lit(0.0))


def month_grid(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every month start in ``[start, end]``: a start that is not a first day
    begins at the next month. Columns: ``month date, month_str string``."""
    one = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return month_grid_from(one, "s", "e")


def month_grid_from(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Month grid from a one-row frame of bounds (e.g. derived from data)."""
    return bounds.select(F.explode(month_starts_between(start_col, end_col)).alias("month")).select(
        "month", format_iso("month").alias("month_str")
    )


def date_range(pixels: DataFrame, start: str, end: str) -> DataFrame:
    """Images with ``start <= image_date < end`` (end exclusive). Pushed to
    the scan (row-group statistics); on the month-partitioned layout
    (``write_pixels``) the implied month range is added on the partition
    column, so whole month folders are skipped."""
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    out = pixels.filter((F.col("image_date") >= s) & (F.col("image_date") < e))
    if "month" in pixels.columns:
        out = out.filter((F.col("month") >= F.trunc(s, "MM")) & (F.col("month") <= F.trunc(F.date_sub(e, 1), "MM")))
    return out


def band_select(pixels: DataFrame, band: str, name: str | None = None) -> DataFrame:
    """Keep one band; the value column is renamed to ``name`` when given."""
    out = pixels.filter(F.col("band") == band)
    return out.withColumnRenamed("value", name) if name else out


def band_math(pixels: DataFrame, scale_factor: float = 1.0, offset: float = 0.0,
              value: str = "value") -> DataFrame:
    """``value * scale_factor + offset`` (e.g. Kelvin to Celsius: offset -273.15)."""
    expr = F.col(value)
    if scale_factor != 1.0:
        expr = expr * float(scale_factor)
    if offset != 0.0:
        expr = expr + float(offset)
    return pixels.withColumn(value, expr)


def month_window(pixels: DataFrame, grid: DataFrame) -> DataFrame:
    """Assign each image to its month window ``[m, m + 1 month)`` and keep
    the months of the grid (a semi join against at most a few hundred grid
    rows; the grid is one row per month, so its broadcast is bounded)."""
    with_month = pixels.withColumn("month", F.trunc(F.col("image_date"), "MM"))
    return with_month.join(F.broadcast(grid.select("month")), "month", "left_semi")


def composite(pixels: DataFrame, kind: str, value: str = "value",
              keys: Sequence[str] = ("month",), weight: str | None = None) -> DataFrame:
    """Per-pixel temporal reduction (mean or sum) within each ``keys`` group,
    each band of a multi-band collection on its own. A pixel's centre (and
    coverage weight) is a function of (ix, iy); should images disagree on it,
    the smallest counts, whatever the order of rows."""
    carry = [F.min("lon").alias("lon"), F.min("lat").alias("lat")]
    if weight:
        carry.append(F.min(weight).alias(weight))
    bands = [c for c in ("band",) if c in pixels.columns and c not in keys]
    return pixels.groupBy(*keys, *bands, *PIXEL_KEYS).agg(reducer(kind, value).alias(value), *carry)


def empty_months(pixels: DataFrame, start: str, end: str, band_col: str = "band") -> DataFrame:
    """(band, month) pairs of the month grid of ``[start, end]`` that have no
    image — the months a monthly loop would skip. Bands come from the pixel
    table; each band row generates its own grid months (no join), and the
    months seen are removed with an anti join."""
    seen = pixels.select(band_col, F.trunc(F.col("image_date"), "MM").alias("month")).distinct()
    bands = seen.select(band_col).distinct()
    pairs = bands.select(band_col, F.explode(month_starts_between(F.lit(start), F.lit(end))).alias("month"))
    return pairs.join(seen, [band_col, "month"], "left_anti").select(
        band_col, "month", format_iso("month").alias("month_str"))


def stack_bands(static_pixels: DataFrame, bands: Sequence[tuple[str, str]]) -> DataFrame:
    """Several single-band images on one grid as one multi-band row per pixel
    (``ix, iy, lon, lat, <name>...``): a pivot written as one conditional
    aggregate, so there is one shuffle and no join of centres back."""
    src = [b for b, _ in bands]
    return (
        static_pixels.filter(F.col("band").isin(*src))
        .groupBy(*PIXEL_KEYS)
        .agg(F.min("lon").alias("lon"), F.min("lat").alias("lat"),
             *[exact_mean(F.when(F.col("band") == b, F.col("value"))).alias(n) for b, n in bands])
    )


def snap_to_grid(pixels: DataFrame, cell_deg: float, value: str = "value",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Resample to a coarser grid: average of the pixels whose centre falls in
    each ``cell_deg`` cell; the cell centre becomes the new pixel centre."""
    c = float(cell_deg)
    gx, gy = F.floor(F.col("lon") / c), F.floor(F.col("lat") / c)
    return (
        pixels.withColumn("gx", gx).withColumn("gy", gy)
        .groupBy(*keys, "gx", "gy")
        .agg(exact_mean(F.col(value)).alias(value), F.count(F.lit(1)).alias("n_pixels"))
        .select(*keys, F.col("gx").alias("ix"), F.col("gy").alias("iy"),
                ((F.col("gx") + 0.5) * c).alias("lon"), ((F.col("gy") + 0.5) * c).alias("lat"),
                value, "n_pixels")
    )
