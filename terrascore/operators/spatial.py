"""Polygon operators: region table, cell index, point-in-polygon join, clip,
zonal statistics and centroids.

Spark has no spatial predicate the optimizer understands, so the join is
written as an equi-join on a grid cell plus an exact residual test:

* each polygon's bounding box is cut into ``cell``-sized cells; one index row
  per (cell, polygon) carries only the polygon edges that a rightward ray from
  inside that cell can cross (exact superset), and cells no edge reaches are
  dropped (no point there can be inside);
* each pixel maps to exactly one cell, so the pixel side never multiplies;
* the join is a hash join on (cx, cy) with the even-odd ray cast as its
  condition. The index is broadcast only when its row and edge counts are
  below the configured bound; beyond that it is a shuffle join on the cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import ensure_checkpoint_dir
from .raster import reducer

REGION_KEYS = ("region_id", "field_id")


def regions(features: DataFrame) -> DataFrame:
    """Feature rows ``(region_id, field_id, geom_type, coordinates)`` →
    ``region_id, field_id, parts, edges, min_x, min_y, max_x, max_y``.
    Rows whose geometry is not a (Multi)Polygon get null parts and no edges. A file of many polygons is small and read by one
    task, so the rows are dealt out before their geometry is worked on."""
    parts = G.parts_from_geojson("geom_type", "coordinates")
    with_parts = features.repartition(max(1, int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")))).select("region_id", "field_id", parts.alias("parts"))
    box = G.bbox("parts")
    return with_parts.select(
        "region_id", "field_id", "parts",
        F.coalesce(G.geometry_edges("parts"), F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")).alias("edges"),
        *[v.alias(k) for k, v in box.items()],
    )


def region_edges(region_df: DataFrame) -> DataFrame:
    """One row per edge: ``region_id, field_id, edge_no, x1, y1, x2, y2``."""
    return region_df.select("region_id", "field_id", F.posexplode("edges").alias("edge_no", "e")).select(
        "region_id", "field_id", "edge_no", "e.x1", "e.y1", "e.x2", "e.y2"
    )


def cell_of(coord, cell_deg: float):
    return F.floor(F.col(coord) / F.lit(float(cell_deg))) if isinstance(coord, str) else F.floor(coord / F.lit(float(cell_deg)))


def cell_index(region_df: DataFrame, cell_deg: float) -> DataFrame:
    """(cx, cy, region_id, field_id, box, edges) — see the module docstring.

    A polygon's edges are narrowed to each row of cells first and to each cell
    of the row after that, so a polygon of many vertices over many cells looks
    at each edge once per row it spans, not once per cell."""
    c = float(cell_deg)
    eps = F.lit(c * 1e-9)
    box = ("min_x", "min_y", "max_x", "max_y")
    rows = region_df.filter(F.col("min_x").isNotNull()).select(
        "region_id", "field_id", "edges", *box,
        F.explode(F.sequence(cell_of("min_y", c), cell_of("max_y", c))).alias("cy"),
    )
    in_row = G.edges_in_rows("edges", F.col("cy") * c, (F.col("cy") + 1) * c, eps)
    cells = rows.withColumn("edges", in_row).filter(F.size("edges") > 0).select(
        "region_id", "field_id", "edges", *box, "cy",
        F.explode(F.sequence(cell_of("min_x", c), cell_of("max_x", c))).alias("cx"),
    )
    near = G.edges_right_of("edges", F.col("cx") * c, eps)
    return cells.select("cx", "cy", "region_id", "field_id", *box, near.alias("edges")).filter(F.size("edges") > 0)


@dataclass
class SpatialIndex:
    """A cell index, and which of its sides may be broadcast: the whole index,
    and the mere list of its cells. The cell is the configured one whatever the
    number of polygons: many polygons make many cells, never large ones."""

    df: DataFrame
    cell_deg: float
    broadcastable: bool
    cells_broadcastable: bool
    regions: DataFrame | None = None

    # Bytes of an index row without edges (keys, ids, box), of an edge (a struct of four doubles in an array) and of a cell.
    ROW_BYTES, EDGE_BYTES, CELL_BYTES = 160, 64, 48

    @classmethod
    def build(cls, region_df: DataFrame, cell_deg: float, max_rows: int,
              max_bytes: int = 256 << 20) -> "SpatialIndex":
        ensure_checkpoint_dir(region_df.sparkSession)
        idx = cell_index(region_df, cell_deg).checkpoint()  # worked out once, not for each series that uses it
        stats = idx.agg(F.count(F.lit(1)).alias("rows"),
                        F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges"),
                        F.count_distinct("cx", "cy").alias("cells")).collect()[0]
        size = stats["rows"] * cls.ROW_BYTES + stats["edges"] * cls.EDGE_BYTES
        return cls(idx, float(cell_deg), stats["rows"] <= max_rows and size <= max_bytes,
                   stats["cells"] * cls.CELL_BYTES <= max_bytes, region_df)

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.broadcastable else self.df

    def cells(self) -> DataFrame:
        """The distinct (cx, cy) that some region reaches: far smaller than the index."""
        cells = self.df.select("cx", "cy").distinct()
        return F.broadcast(cells) if self.cells_broadcastable else cells


def _inside_test(p: DataFrame, idx: DataFrame):
    """Bounding-box pre-test (compiled, short-circuits) then the exact ray
    cast over the cell's edges."""
    in_box = (p["lon"] >= idx["min_x"]) & (p["lon"] <= idx["max_x"]) & (p["lat"] >= idx["min_y"]) & (p["lat"] <= idx["max_y"])
    return in_box & G.point_in_polygon(p["lon"], p["lat"], idx["edges"])


def _with_cell(pixels: DataFrame, cell_deg: float) -> DataFrame:
    return pixels.withColumn("_cx", cell_of("lon", cell_deg)).withColumn("_cy", cell_of("lat", cell_deg))


def pixels_in_regions(pixels: DataFrame, index: SpatialIndex) -> DataFrame:
    """Every (pixel row, region) pair with the pixel centre inside the region
    (holes excluded). Pixels in overlapping regions appear once per region."""
    p = _with_cell(pixels, index.cell_deg)
    idx = index.side().withColumnRenamed("cx", "_icx").withColumnRenamed("cy", "_icy")
    cond = (p["_cx"] == idx["_icx"]) & (p["_cy"] == idx["_icy"]) & _inside_test(p, idx)
    return p.join(idx, cond, "inner").drop("_cx", "_cy", "_icx", "_icy", "edges", "min_x", "min_y", "max_x", "max_y")


def clip(pixels: DataFrame, index: SpatialIndex, exact: bool = True) -> DataFrame:
    """Pixels inside the union of the regions (each pixel once). ``exact=False``
    keeps every pixel of a cell some region reaches: a cheap pre-filter with
    no false negatives, used before the temporal composite."""
    p = _with_cell(pixels, index.cell_deg)
    idx = (index.side() if exact else index.cells()).withColumnRenamed("cx", "_icx").withColumnRenamed("cy", "_icy")
    cond = (p["_cx"] == idx["_icx"]) & (p["_cy"] == idx["_icy"])
    if exact:
        cond = cond & _inside_test(p, idx)
    return p.join(idx, cond, "left_semi").drop("_cx", "_cy")


def zonal_stats(pixels: DataFrame, index: SpatialIndex, kind: str, value: str = "value",
                keys: Sequence[str] = ("month",), out: str | None = None,
                weight: str | None = None) -> DataFrame:
    """Reduce the pixels of every region (per feature, not per id: two
    polygons sharing an id give two rows) within each ``keys`` group.
    Regions without pixels give no row. Partial aggregation before the
    shuffle absorbs regions that hold most pixels."""
    joined = pixels_in_regions(pixels, index)
    return joined.groupBy(*REGION_KEYS, *keys).agg(reducer(kind, value, weight).alias(out or value))


def zonal_stats_multi(pixels: DataFrame, index: SpatialIndex, columns: Sequence[str],
                      kind: str = "mean", keys: Sequence[str] = ()) -> DataFrame:
    """Zonal reduction of several band columns in one pass."""
    joined = pixels_in_regions(pixels, index)
    aggs = [reducer(kind, c).alias(c) for c in columns]
    return joined.groupBy(*REGION_KEYS, *keys).agg(*aggs)


def centroids(region_df: DataFrame) -> DataFrame:
    """``region_id, field_id, lon, lat`` — area-weighted centroid per region."""
    c = G.centroid("parts")
    return region_df.select("region_id", "field_id", c["lon"].alias("lon"), c["lat"].alias("lat"))
