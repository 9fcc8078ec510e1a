"""Extraction jobs: pixel tables + polygons → raw monthly series and soil rows.

One lazy plan per series, all months at once::

    scan(band, [start, end)) → month window ⋉ grid → coarse clip (cell index)
      → per-pixel temporal composite (shuffle 1, partial agg)
      → band math → exact point-in-polygon join (broadcast index if small)
      → zonal reduction per region and month (shuffle 2, partial agg)
      → drop rows without id or value → text date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig, SourceSpec
from ..operators import raster as R
from ..operators.coverage import CoverageIndex, clip_covered, zonal_covered
from ..operators.spatial import SpatialIndex, centroids, clip, zonal_stats, zonal_stats_multi
from ..functions.dates import format_iso


def build_index(region_df: DataFrame, cfg: PipelineConfig) -> SpatialIndex:
    return SpatialIndex.build(region_df, cfg.cell_deg, cfg.max_broadcast_rows, cfg.max_broadcast_bytes)


def series_rows(zonal: DataFrame, name: str) -> DataFrame:
    """Rows as the loader keeps them: a non-empty id and a non-null value;
    ``field_id, <name>, date`` with the month as ``yyyy-MM-dd`` text."""
    keep = F.col("field_id").isNotNull() & (F.col("field_id") != "") & F.col(name).isNotNull()
    return zonal.filter(keep).select("field_id", F.col(name), format_iso("month").alias("date"))


def monthly_composite(spark: SparkSession, pixels: DataFrame, spec: SourceSpec, cfg: PipelineConfig,
                      index: SpatialIndex | CoverageIndex | None = None) -> DataFrame:
    """Per-pixel monthly composite of one band over the run period, with the
    band math applied after the temporal reduction (as the source does)."""
    p = R.date_range(R.band_select(pixels, spec.band), cfg.start_date, cfg.end_date)
    grid = R.month_grid(spark, cfg.start_date, cfg.end_date)
    p = R.month_window(p, grid)
    if isinstance(index, CoverageIndex):
        p = clip_covered(p, index)
    elif index is not None:
        p = clip(p, index, exact=False)
    comp = R.composite(p, spec.temporal, weight=spec.weight)
    return R.band_math(comp, spec.scale_factor, spec.offset)


def extract_series(spark: SparkSession, pixels: DataFrame, index: SpatialIndex, spec: SourceSpec,
                   cfg: PipelineConfig) -> DataFrame:
    """Raw series rows ``field_id, <spec.name>, date`` for every polygon and
    month of the run (months without images simply produce nothing). A source with
    ``pixel_deg`` counts each pixel by its covered share, others by its centre."""
    if spec.pixel_deg:
        covered = CoverageIndex.build(index.regions, cfg.cell_deg, spec.pixel_deg, cfg.max_broadcast_rows, cfg.max_broadcast_bytes)
        comp = monthly_composite(spark, pixels, spec, cfg, covered)
        return series_rows(zonal_covered(comp, covered, spec.zonal, keys=("month",), out=spec.name), spec.name)
    comp = monthly_composite(spark, pixels, spec, cfg, index)
    z = zonal_stats(comp, index, spec.zonal, keys=("month",), out=spec.name, weight=spec.weight)
    return series_rows(z, spec.name)


def extract_static(static_pixels: DataFrame, region_df: DataFrame, index: SpatialIndex,
                   cfg: PipelineConfig) -> DataFrame:
    """Soil rows ``field_id, soil_ph, soil_cec, clay, silt, sand, lat, lon``:
    bands stacked, zonal mean per polygon, plus the polygon's centroid. Every
    polygon with a non-empty id gives a row; its values are null when no
    pixel falls inside."""
    names = [n for _, n in cfg.soil_bands]
    near = clip(static_pixels, index, exact=False)   # before the shuffle of the stack, not after it
    stack = R.stack_bands(near, cfg.soil_bands)
    z = zonal_stats_multi(stack, index, names, "mean")
    cents = centroids(region_df)
    rows = cents.join(z.drop("field_id"), "region_id", "left")
    keep = F.col("field_id").isNotNull() & (F.col("field_id") != "")
    return rows.filter(keep).select("field_id", *names, "lat", "lon")
