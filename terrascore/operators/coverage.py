"""Covered fractions: the share of each pixel's square that a polygon covers.

The reduction by pixel centres counts a pixel wholly or not at all. Here a pixel
counts by the area of its square inside the polygon. That area is a sum over the polygon's edges, so no clipped polygon
is ever built: over the square's width, an edge of a ring contributes the integral of its height above the
square's bottom, cut at the square's top, with the sign of its direction (exteriors turn one way, holes the other).
What lies under the upper edges less what lies under the lower ones is the covered area.

A cell of the index holds only the edges that pass over or through squares whose centre is in the cell, so a
pixel looks at the edges above it and the rest of a large polygon stays away.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import ensure_checkpoint_dir
from .raster import reducer
from .spatial import REGION_KEYS, _with_cell, cell_of

#: Shares up to this are rounding of squares that only touch the polygon.
LEAST = 1e-9


@dataclass
class CoverageIndex:
    """(cx, cy, region_id, field_id, edges) for pixels of ``pixel_deg``, and whether it may be broadcast."""

    df: DataFrame
    cell_deg: float
    pixel_deg: float
    broadcastable: bool

    ROW_BYTES, EDGE_BYTES = 128, 64

    @classmethod
    def build(cls, region_df: DataFrame, cell_deg: float, pixel_deg: float, max_rows: int, max_bytes: int = 256 << 20) -> "CoverageIndex":
        ensure_checkpoint_dir(region_df.sparkSession)
        df = coverage_cells(region_df, cell_deg, pixel_deg).checkpoint()
        stats = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges")).first()
        size = stats["rows"] * cls.ROW_BYTES + stats["edges"] * cls.EDGE_BYTES
        return cls(df, float(cell_deg), float(pixel_deg), stats["rows"] <= max_rows and size <= max_bytes)


def coverage_cells(region_df: DataFrame, cell_deg: float, pixel_deg: float) -> DataFrame:
    """One row for each polygon and cell that may hold the centre of a square it covers in part."""
    c, half = float(cell_deg), float(pixel_deg) / 2 * (1 + 1e-9)
    turned = region_df.where(F.col("min_x").isNotNull()).select(*REGION_KEYS, G.oriented_edges("parts").alias("edges"), "min_x", "max_x", "min_y", "max_y")
    columns = turned.select(
        *REGION_KEYS, "edges", "min_y", "max_y", F.explode(F.sequence(cell_of(F.col("min_x") - half, c), cell_of(F.col("max_x") + half, c))).alias("cx"))
    lo, hi = F.col("cx") * c - half, (F.col("cx") + 1) * c + half
    near = F.filter("edges", lambda e: (F.greatest(e["x1"], e["x2"]) >= lo) & (F.least(e["x1"], e["x2"]) <= hi) & (e["x1"] != e["x2"]))
    # first the edges of a column of cells, then those not below each of its cells
    cells = columns.withColumn("edges", near).where(F.size("edges") > 0).select(
        *REGION_KEYS, "edges", "cx", F.explode(F.sequence(cell_of(F.col("min_y") - half, c), cell_of(F.col("max_y") + half, c))).alias("cy"))
    above = F.filter("edges", lambda e: F.greatest(e["y1"], e["y2"]) >= F.col("cy") * c - half)
    return cells.select("cx", "cy", *REGION_KEYS, above.alias("edges")).where(F.size("edges") > 0)


def _mean_above(a: Column, b: Column) -> Column:
    """Mean of max(y, 0) along a line from height a to height b, without cancellation."""
    high = F.greatest(a, b)
    return (F.when((a >= 0) & (b >= 0), (a + b) / 2).when(high <= 0, F.lit(0.0)).otherwise(high * high / (F.abs(b - a) * 2)))


def covered_share(lon: Column, lat: Column, edges: Column, pixel_deg: float) -> Column:
    """Covered part (0 to 1) of the square of ``pixel_deg`` about (lon, lat); edges as ``geometry.oriented_edges`` has them."""
    size = float(pixel_deg)
    left, bottom = lon - size / 2, lat - size / 2

    def under(e: Column) -> Column:
        # the part of the edge over the square's width, in the square's coordinates
        x1, x2 = e["x1"] - left, e["x2"] - left
        y1, y2 = e["y1"] - bottom, e["y2"] - bottom
        slope = (y2 - y1) / F.nullif(x2 - x1, F.lit(0.0))
        a, b = F.greatest(F.least(x1, F.lit(size)), F.lit(0.0)), F.greatest(F.least(x2, F.lit(size)), F.lit(0.0))
        ya, yb = y1 + slope * (a - x1), y1 + slope * (b - x1)
        return F.when(a == b, F.lit(0.0)).otherwise((b - a) * (_mean_above(ya, yb) - _mean_above(ya - size, yb - size)))

    total = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + under(e))
    return F.least(F.greatest(-total / (size * size), F.lit(0.0)), F.lit(1.0))


def pixels_covered(pixels: DataFrame, index: CoverageIndex, name: str = "coverage") -> DataFrame:
    """Every (pixel row, region) whose square the region covers in part, with the share in ``name``."""
    p = _with_cell(pixels, index.cell_deg)
    side = index.df.withColumnRenamed("cx", "_icx").withColumnRenamed("cy", "_icy")
    side = F.broadcast(side) if index.broadcastable else side
    met = p.join(side, (p["_cx"] == side["_icx"]) & (p["_cy"] == side["_icy"]))
    share = covered_share(F.col("lon"), F.col("lat"), F.col("edges"), index.pixel_deg)
    # as an exploded column the share is worked out once, not in the filter and again after it
    return met.withColumn(name, F.explode(F.array(share))).where(F.col(name) > LEAST).drop("_cx", "_cy", "_icx", "_icy", "edges")


def clip_covered(pixels: DataFrame, index: CoverageIndex) -> DataFrame:
    """The pixels of cells that some region may cover: a cheap superset, for the side before a composite's shuffle."""
    p = _with_cell(pixels, index.cell_deg)
    cells = index.df.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy")).distinct()
    return p.join(F.broadcast(cells) if index.broadcastable else cells, ["_cx", "_cy"], "left_semi").drop("_cx", "_cy")


def zonal_covered(pixels: DataFrame, index: CoverageIndex, kind: str, value: str = "value", keys: Sequence[str] = ("month",),
                  out: str | None = None) -> DataFrame:
    """Zonal mean or sum of each region, each pixel weighted by its covered share. A place has many rows (months,
    bands) but one share in each region: that is worked out once a place and joined to the rows."""
    met = pixels.join(pixels_covered(pixels.select("lon", "lat").distinct(), index, "_coverage"), ["lon", "lat"])
    return met.groupBy(*REGION_KEYS, *keys).agg(reducer(kind, value, "_coverage").alias(out or value), reducer("sum", "_coverage").alias("covered_pixels"))
