"""Adapters from the driver's TPC-H-like tables to this model's inputs.

The recipes are documented in FIXTURES.md; ``terrascore.oracle`` states the
same recipes in DuckDB SQL. Every adapter reads whole tables: the work
grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SOIL_BANDS, SourceSpec
from ..functions.dates import format_iso, month_start

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Pixel grid of the synthetic rasters: each supplier owns a block of BLOCK x BLOCK pixels of PIXEL_DEG degrees,
# BLOCKS_X blocks to a row. The grid grows with the keys; how far a polygon reaches over its block doesn't.
GRID_X0, GRID_Y0, PIXEL_DEG, BLOCK, BLOCKS_X = -9.0, 30.0, 0.001, 10, 100

# Bands of the synthetic collection (l_returnflag) and how each becomes a
# series in the test configuration.
TEST_SERIES = (
    SourceSpec("ndvi", band="A", scale_factor=0.02),
    SourceSpec("temperature", band="N", offset=-5.0),
    SourceSpec("rainfall", band="R", temporal="sum", zonal="sum"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def field_key(suppkey) -> Column:
    c = F.col(suppkey) if isinstance(suppkey, str) else suppkey
    return F.concat(F.lit("field_"), c.cast("string"))


# ---- monthly series and soil straight from lineitem / supplier -------------

def _series(spark, sf_dir, flag: str, value: Column, name: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag)
    keyed = li.select(field_key("l_suppkey").alias("field_id"), month_start("l_shipdate").alias("date"),
                      "l_discount", "l_quantity")
    return keyed.groupBy("field_id", "date").agg(value.alias(name))


def ndvi_series(spark, sf_dir) -> DataFrame:
    """field_id, date (date), ndvi = avg(l_discount) * 10 over returnflag A, from whole hundredths (exact in any order)."""
    hundredths = F.sum(F.round(F.col("l_discount") * 100).cast("long"))
    return _series(spark, sf_dir, "A", hundredths.cast("double") / (F.count("l_discount") * 10), "ndvi")


def temperature_series(spark, sf_dir) -> DataFrame:
    """temperature = avg(l_quantity) - 5 over returnflag N."""
    return _series(spark, sf_dir, "N", F.avg("l_quantity") - 5, "temperature")


def rainfall_series(spark, sf_dir) -> DataFrame:
    """rainfall = sum(l_quantity) * 2 over returnflag R."""
    return _series(spark, sf_dir, "R", F.sum("l_quantity") * 2, "rainfall")


def raw_series(series: DataFrame, name: str) -> DataFrame:
    """As a loader writes it: ``field_id, <name>, date`` with text dates."""
    return series.select("field_id", name, format_iso("date").alias("date"))


def soil_raw(spark, sf_dir) -> DataFrame:
    """One soil row per supplier; pH is unknown for negative balances and sand
    for balances above 9000."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    d = lambda x: F.lit(float(x))
    return s.select(
        field_key("s_suppkey").alias("field_id"),
        F.when(F.col("s_acctbal") >= 0, d(5) + (k % 40).cast("double") / d(10)).alias("soil_ph"),
        (d(5) + (k % 41).cast("double")).alias("soil_cec"),
        (d(10) + (k % 45).cast("double")).alias("clay"),
        (d(20) + ((k * 7) % 45).cast("double")).alias("silt"),
        F.when(F.col("s_acctbal") > 9000, F.lit(None).cast("double"))
        .otherwise(d(15) + ((k * 3) % 60).cast("double")).alias("sand"),
        (d(27) + d(0.3) * F.col("s_nationkey").cast("double")).alias("lat"),
        (d(-13) + d(0.1) * (k % 100).cast("double")).alias("lon"),
    )


# ---- synthetic rasters and polygons ----------------------------------------

def _centre(idx: Column, origin: float) -> Column:
    return F.lit(origin) + F.lit(PIXEL_DEG) * idx.cast("double") + F.lit(PIXEL_DEG / 2)


def _block_pixel(block: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    """Grid position of pixel (dx, dy) of a block."""
    return ((block % BLOCKS_X) * BLOCK + dx).cast("long"), (F.floor(block / BLOCKS_X) * BLOCK + dy).cast("long")


def pixels(spark, sf_dir) -> DataFrame:
    """Time-indexed pixel table from lineitem: one image row per line item,
    ``band = l_returnflag``, the pixel ``l_partkey`` names in the block of
    ``l_suppkey``, ``value = l_quantity``."""
    li = table(spark, sf_dir, "lineitem")
    ix, iy = _block_pixel(F.col("l_suppkey"), F.col("l_partkey") % BLOCK, F.floor(F.col("l_partkey") / BLOCK) % BLOCK)
    return li.select(
        F.to_date("l_shipdate").alias("image_date"), F.col("l_returnflag").alias("band"),
        ix.alias("ix"), iy.alias("iy"), _centre(ix, GRID_X0).alias("lon"), _centre(iy, GRID_Y0).alias("lat"),
        F.col("l_quantity").alias("value"),
    )


def static_pixels(spark, sf_dir) -> DataFrame:
    """Undated soil images from part, long form (one row per part and band):
    20 parts fall into each block."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("long")
    d = lambda x: F.lit(float(x))
    ix, iy = _block_pixel(F.floor(F.col("p_partkey") / 20), (F.col("p_partkey") * 7) % BLOCK, (F.col("p_partkey") * 3) % BLOCK)
    values = {
        "phh2o": d(5) + (size % 40).cast("double") / d(10),
        "cec": d(5) + (size % 41).cast("double"),
        "clay": d(10) + ((size * 7) % 45).cast("double"),
        "silt": d(20) + ((size * 11) % 45).cast("double"),
        "sand": d(15) + ((size * 3) % 60).cast("double"),
    }
    assert [b for b, _ in SOIL_BANDS] == list(values)
    stacked = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), v.alias("value")) for b, v in values.items()]))
    return p.select(ix.alias("ix"), iy.alias("iy"), stacked.alias("b")).select(
        "b.band", "ix", "iy", _centre(F.col("ix"), GRID_X0).alias("lon"), _centre(F.col("iy"), GRID_Y0).alias("lat"),
        "b.value",
    )


# Unit shapes (exterior first, then holes), scaled and moved per supplier.
SHAPES = (
    [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]],
    [[(0, 0), (1, 0), (1, 0.25), (0.25, 0.25), (0.25, 1), (0, 1), (0, 0)]],
    [[(0, 0), (1, 0.05), (0.45, 1), (0, 0)]],
    [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [(0.3, 0.3), (0.3, 0.7), (0.7, 0.7), (0.7, 0.3), (0.3, 0.3)]],
)


def _shape_literal(rings) -> Column:
    return F.array(*[F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ring]) for ring in rings])


def polygon_features(spark, sf_dir) -> DataFrame:
    """One polygon per supplier: ``region_id, field_id, geom_type,
    coordinates`` (GeoJSON text). Shape ``s_suppkey % 4`` of SHAPES (square,
    concave L, triangle, square with a hole), anchored a little outside or
    inside of its block's corner, with an edge of 0.7 to 1.3 blocks: it covers part of
    its own block and at times a strip of the next ones, at every scale."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    width = PIXEL_DEG * BLOCK
    x0 = F.lit(GRID_X0 - 0.00237) + F.lit(width) * (k % BLOCKS_X).cast("double") + F.lit(0.00061) * (k % 7).cast("double")
    y0 = F.lit(GRID_Y0 - 0.00173) + F.lit(width) * F.floor(k / BLOCKS_X).cast("double") + F.lit(0.00047) * (k % 5).cast("double")
    size = F.lit(0.00703) + F.lit(0.00151) * (k % 5).cast("double")
    shape = k % len(SHAPES)
    tmpl = None
    for i, rings in enumerate(SHAPES):
        tmpl = F.when(shape == i, _shape_literal(rings)) if tmpl is None else tmpl.when(shape == i, _shape_literal(rings))
    placed = s.select(k.alias("region_id"), field_key(k).alias("field_id"), x0.alias("x0"), y0.alias("y0"),
                      size.alias("size"), tmpl.alias("tmpl"))
    rings = F.transform("tmpl", lambda ring: F.transform(ring, lambda p: F.array(
        F.col("x0") + F.col("size") * F.get(p, 0), F.col("y0") + F.col("size") * F.get(p, 1))))
    return placed.select("region_id", "field_id", F.lit("Polygon").alias("geom_type"),
                         F.to_json(rings).alias("coordinates"))
