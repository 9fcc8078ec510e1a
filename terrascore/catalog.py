"""Registered queries: one Spark query per operator of the inventory, each run
on the driver's tables at a given scale-factor folder, plus its DuckDB
oracle (where the operator is SQL-expressible).

Every query reads whole tables (through the adapters of ``plans.testdata``)
and returns its final columns with doubles rounded to 6 decimals — the
rounding is applied here only, never inside the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .config import SEASONAL_FEATURES, SOIL_FEATURES
from .functions.dates import month_of, year_of
from .functions.scoring import season_label, trapezoid_score
from .operators import aggregates as A
from .operators.joins import BOUNDS, full_outer_chain
from .plans import harmonize as H
from .plans import marts as M
from .plans import scoring as S
from .plans import staging as STG
from .plans import testdata as TD
from .sources.tables import seed_thresholds

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---- shared inputs (all lazily planned) ------------------------------------

def stg_inputs(spark: SparkSession, sf: str):
    ndvi = STG.stg_ndvi(TD.raw_series(TD.ndvi_series(spark, sf), "ndvi"))
    temp = STG.stg_temperature(TD.raw_series(TD.temperature_series(spark, sf), "temperature"))
    rain = STG.stg_rainfall(TD.raw_series(TD.rainfall_series(spark, sf), "rainfall"))
    soil = STG.stg_soil(TD.soil_raw(spark, sf))
    return ndvi, temp, rain, soil


def harmonized(spark: SparkSession, sf: str) -> DataFrame:
    return H.harmonize(*stg_inputs(spark, sf))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return S.fact_suitability(harmonized(spark, sf), seed_thresholds(spark))


FACT_DOUBLES = ("ndvi", "temperature", "rainfall", *SOIL_FEATURES,
                *[f"{f}_score" for f in SEASONAL_FEATURES + SOIL_FEATURES], "total_suitability_score")
HARM_DOUBLES = ("ndvi", "temperature", "rainfall", *SOIL_FEATURES)
ASSESS_DOUBLES = tuple(c for c in M.ASSESSMENT_COLUMNS if c != "field_id")


# ---- staging ---------------------------------------------------------------

@register("stg_ndvi", O.sql("SELECT * FROM stg_ndvi", "stg_ndvi", doubles=("ndvi",)))
def q_stg_ndvi(spark, sf):
    return stg_inputs(spark, sf)[0]


@register("stg_temperature", O.sql("SELECT * FROM stg_temperature", "stg_temperature", doubles=("temperature",)))
def q_stg_temperature(spark, sf):
    return stg_inputs(spark, sf)[1]


@register("stg_rainfall", O.sql("SELECT * FROM stg_rainfall", "stg_rainfall", doubles=("rainfall",)))
def q_stg_rainfall(spark, sf):
    return stg_inputs(spark, sf)[2]


@register("stg_soil", O.sql("SELECT * FROM stg_soil", "stg_soil",
                            doubles=("lat", "lon", *SOIL_FEATURES)))
def q_stg_soil(spark, sf):
    return stg_inputs(spark, sf)[3]


# ---- joins, season, harmonized --------------------------------------------

@register("join_full_outer_2way", O.sql(
    "SELECT coalesce(n.field_id, t.field_id) AS field_id, coalesce(n.date, t.date) AS date, n.ndvi, t.temperature "
    "FROM stg_ndvi n FULL OUTER JOIN stg_temperature t ON n.field_id = t.field_id AND n.date = t.date",
    "stg_ndvi", "stg_temperature", doubles=("ndvi", "temperature")))
def q_join_2way(spark, sf):
    n, t, _, _ = stg_inputs(spark, sf)
    return full_outer_chain([n, t], ["field_id", "date"]).select("field_id", "date", "ndvi", "temperature")


@register("join_full_outer_3way", O.sql(
    "SELECT field_id, date, month, ndvi, temperature, rainfall, agricultural_period FROM harmonized",
    "harmonized", doubles=("ndvi", "temperature", "rainfall")))
def q_join_3way(spark, sf):
    n, t, r, _ = stg_inputs(spark, sf)
    return H.series_by_month(n, t, r)


@register("season_label", O.sql(
    "SELECT DISTINCT month, agricultural_period FROM harmonized", "harmonized"))
def q_season_label(spark, sf):
    n, t, r, _ = stg_inputs(spark, sf)
    md = full_outer_chain([n, t, r], ["field_id", "date"])
    return md.select(month_of("date").alias("month")).distinct().select(
        "month", season_label("month").alias("agricultural_period"))


@register("fn_date_parts", O.sql(
    "SELECT DISTINCT date, CAST(extract(year FROM date) AS BIGINT) AS year, "
    "CAST(extract(month FROM date) AS BIGINT) AS month FROM harmonized", "harmonized"))
def q_date_parts(spark, sf):
    n, t, r, _ = stg_inputs(spark, sf)
    d = H.series_by_month(n, t, r).select("date").distinct()
    return d.select("date", year_of("date").alias("year"), month_of("date").alias("month"))


@register("int_harmonized", O.sql("SELECT * FROM harmonized", "harmonized", doubles=HARM_DOUBLES))
def q_harmonized(spark, sf):
    return harmonized(spark, sf)


@register("int_harmonized_unique_keys", O.sql("SELECT * FROM harmonized", "harmonized", doubles=HARM_DOUBLES))
def q_harmonized_unique(spark, sf):
    return H.harmonize(*stg_inputs(spark, sf), unique_keys=True)


# ---- thresholds and scores -------------------------------------------------

_SEASONAL_BOUND_COLS = [f"ndvi_{b}" for b in BOUNDS]


@register("join_threshold_seasonal", O.sql(
    "SELECT h.field_id, h.date, h.agricultural_period, "
    + ", ".join(f"t.{b} AS ndvi_{b}" for b in BOUNDS)
    + " FROM harmonized h LEFT JOIN thresholds t ON h.agricultural_period = t.period AND t.feature = 'ndvi'",
    "harmonized", "thresholds", doubles=tuple(_SEASONAL_BOUND_COLS)))
def q_join_seasonal(spark, sf):
    from .operators.joins import attach_seasonal_bounds
    h = harmonized(spark, sf)
    return attach_seasonal_bounds(h, seed_thresholds(spark), "ndvi").select(
        "field_id", "date", "agricultural_period", *_SEASONAL_BOUND_COLS)


_STATIC_BOUND_COLS = [f"{f}_{b}" for f in SOIL_FEATURES for b in BOUNDS]


@register("join_threshold_static", O.sql(
    "SELECT h.field_id, h.date, "
    + ", ".join(f"t_{f}.{b} AS {f}_{b}" for f in SOIL_FEATURES for b in BOUNDS)
    + " FROM harmonized h "
    + " ".join(f"LEFT JOIN thresholds t_{f} ON t_{f}.period = 'static' AND t_{f}.feature = '{f}'"
               for f in SOIL_FEATURES),
    "harmonized", "thresholds", doubles=tuple(_STATIC_BOUND_COLS)))
def q_join_static(spark, sf):
    from .operators.joins import attach_static_bounds
    h = harmonized(spark, sf)
    return attach_static_bounds(h, seed_thresholds(spark), SOIL_FEATURES).select(
        "field_id", "date", *_STATIC_BOUND_COLS)


@register("score_trapezoid", O.sql(
    "SELECT m.field_id, m.date, m.feature, m.value, " + O.trapezoid_sql("m.value", "t") + " AS score FROM ("
    + " UNION ALL ".join(
        f"SELECT field_id, date, '{f}' AS feature, {f} AS value, "
        + ("agricultural_period" if f in SEASONAL_FEATURES else "'static'") + " AS period FROM harmonized"
        for f in SEASONAL_FEATURES + SOIL_FEATURES)
    + ") m LEFT JOIN thresholds t ON t.feature = m.feature AND t.period = m.period",
    "harmonized", "thresholds", doubles=("value", "score")))
def q_score_trapezoid(spark, sf):
    """Long form: every (row, feature) scored against its bounds — the generic
    score on all eight features through one join on (feature, period)."""
    h = harmonized(spark, sf)
    feats = SEASONAL_FEATURES + SOIL_FEATURES
    long = h.select("field_id", "date", "agricultural_period",
                    F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"))
                                        for f in feats])).alias("m")).select(
        "field_id", "date", "agricultural_period", "m.feature", "m.value")
    period = F.when(F.col("feature").isin(*SEASONAL_FEATURES), F.col("agricultural_period")).otherwise(F.lit("static"))
    long = long.withColumn("_period", period)
    t = F.broadcast(seed_thresholds(spark))  # 14 rows, fixed by the seed
    j = long.join(t, (long["feature"] == t["feature"]) & (long["_period"] == t["period"]), "left")
    return j.select("field_id", "date", long["feature"], "value",
                    trapezoid_score(F.col("value"), *[t[b] for b in BOUNDS]).alias("score"))


def _score_query(feature: str):
    @register(f"score_{feature}", O.sql(
        f"SELECT field_id, date, agricultural_period, {feature}, {feature}_score FROM fact", "fact",
        doubles=(feature, f"{feature}_score")))
    def q(spark, sf):
        return fact(spark, sf).select("field_id", "date", "agricultural_period", feature, f"{feature}_score")
    return q


for _f in SEASONAL_FEATURES:
    _score_query(_f)

_SOIL_SCORE_COLS = [f"{f}_score" for f in SOIL_FEATURES]


@register("score_soil", O.sql(
    "SELECT field_id, date, " + ", ".join(SOIL_FEATURES) + ", " + ", ".join(_SOIL_SCORE_COLS) + " FROM fact",
    "fact", doubles=(*SOIL_FEATURES, *_SOIL_SCORE_COLS)))
def q_score_soil(spark, sf):
    return fact(spark, sf).select("field_id", "date", *SOIL_FEATURES, *_SOIL_SCORE_COLS)


@register("score_total", O.sql(
    "SELECT field_id, date, total_suitability_score FROM fact", "fact", doubles=("total_suitability_score",)))
def q_score_total(spark, sf):
    return fact(spark, sf).select("field_id", "date", "total_suitability_score")


# ---- marts and aggregates ----------------------------------------------------

@register("mart_fact_suitability", O.sql("SELECT * FROM fact", "fact", doubles=FACT_DOUBLES))
def q_fact(spark, sf):
    return fact(spark, sf)


@register("mart_dim_date", O.sql("SELECT * FROM dim_date ORDER BY date", "dim_date"))
def q_dim_date(spark, sf):
    return M.dim_date(harmonized(spark, sf))


@register("mart_dim_location", O.sql("SELECT * FROM dim_location", "dim_location",
                                     doubles=("latitude", "longitude", *SOIL_FEATURES)))
def q_dim_location(spark, sf):
    return M.dim_location(stg_inputs(spark, sf)[3])


_FS_DOUBLES = tuple(out for _, out in A.FIELD_SEASON_MEASURES)


@register("agg_field_season", O.sql("SELECT * FROM field_season", "field_season", doubles=_FS_DOUBLES))
def q_field_season(spark, sf):
    return A.field_season_averages(fact(spark, sf))


_PIVOT_DOUBLES = tuple(c for c in M.ASSESSMENT_COLUMNS[8:])


@register("agg_pivot_seasons", O.sql("SELECT * FROM pivoted", "pivoted", doubles=_PIVOT_DOUBLES))
def q_pivot(spark, sf):
    return A.pivot_seasons(A.field_season_averages(fact(spark, sf)))


@register("mart_assessment", O.sql("SELECT * FROM assessment", "assessment", doubles=ASSESS_DOUBLES))
def q_assessment(spark, sf):
    f = fact(spark, sf)
    return M.assessment_dataset(f, M.dim_location(stg_inputs(spark, sf)[3]))


# ---- rasters, spatial join, zonal statistics, extraction jobs --------------

from .config import PipelineConfig  # noqa: E402
from .operators import coverage as CV  # noqa: E402
from .operators import raster as R  # noqa: E402
from .operators import spatial as SP  # noqa: E402
from .plans import extract as X  # noqa: E402

TEST_CFG = PipelineConfig(start_date=O.RUN_START, end_date=O.RUN_END, series=TD.TEST_SERIES, cell_deg=0.005, polygon_set="suppliers")
_SPEC = {s.name: s for s in TD.TEST_SERIES}


def regions(spark, sf):
    return SP.regions(TD.polygon_features(spark, sf))


def index(spark, sf, cfg: PipelineConfig = TEST_CFG):
    return X.build_index(regions(spark, sf), cfg)


def data_grid(spark, sf):
    px = TD.pixels(spark, sf)
    bounds = px.agg(F.trunc(F.min("image_date"), "year").alias("s"),
                    F.make_date(F.year(F.max("image_date")), F.lit(12), F.lit(31)).alias("e"))
    return R.month_grid_from(bounds, "s", "e")


@register("ras_month_grid", O.sql("SELECT * FROM data_grid", "data_grid"))
def q_month_grid(spark, sf):
    return data_grid(spark, sf)


@register("ras_empty_months", O.sql(
    "SELECT b.band, g.month, g.month_str FROM (SELECT DISTINCT band FROM pixels) b CROSS JOIN data_grid g "
    "WHERE NOT EXISTS (SELECT 1 FROM pixels p WHERE p.band = b.band "
    "AND CAST(date_trunc('month', p.image_date) AS DATE) = g.month)", "pixels", "data_grid"))
def q_empty_months(spark, sf):
    px = TD.pixels(spark, sf)
    # the grid bounds: two dates from one aggregate (whole years of the data)
    lo, hi = px.agg(F.min("image_date"), F.max("image_date")).first()
    return R.empty_months(px, f"{lo.year}-01-01", f"{hi.year}-12-31")


_PX_DOUBLES = ("lon", "lat", "value")


@register("ras_date_range", O.sql(
    f"SELECT * FROM pixels WHERE image_date >= DATE '{O.RUN_START}' AND image_date < DATE '1998-07-01'",
    "pixels", doubles=_PX_DOUBLES))
def q_date_range(spark, sf):
    return R.date_range(TD.pixels(spark, sf), O.RUN_START, "1998-07-01")


@register("ras_month_window", O.sql(
    "SELECT band, month, count(*) AS n_images, count(DISTINCT image_date) AS n_dates FROM px_window "
    "GROUP BY band, month", "px_window"))
def q_month_window(spark, sf):
    p = R.date_range(TD.pixels(spark, sf), TEST_CFG.start_date, TEST_CFG.end_date)
    w = R.month_window(p, R.month_grid(spark, TEST_CFG.start_date, TEST_CFG.end_date))
    return w.groupBy("band", "month").agg(F.count(F.lit(1)).alias("n_images"),
                                         F.countDistinct("image_date").alias("n_dates"))


def _window(spark, sf, band=None):
    p = R.date_range(TD.pixels(spark, sf), TEST_CFG.start_date, TEST_CFG.end_date)
    p = R.band_select(p, band) if band else p
    return R.month_window(p, R.month_grid(spark, TEST_CFG.start_date, TEST_CFG.end_date))


@register("ras_composite_mean", O.sql("SELECT * FROM comp_mean", "comp_mean", doubles=_PX_DOUBLES))
def q_comp_mean(spark, sf):
    return R.composite(_window(spark, sf), "mean")


@register("ras_composite_sum", O.sql("SELECT * FROM comp_sum", "comp_sum", doubles=_PX_DOUBLES))
def q_comp_sum(spark, sf):
    return R.composite(_window(spark, sf), "sum")


@register("ras_band_select", O.sql(
    "SELECT image_date, band, ix, iy, lon, lat, value AS temperature FROM pixels WHERE band = 'N'",
    "pixels", doubles=("lon", "lat", "temperature")))
def q_band_select(spark, sf):
    return R.band_select(TD.pixels(spark, sf), "N", "temperature")


@register("ras_band_math", O.sql("SELECT * FROM comp_temperature", "comp_temperature", doubles=_PX_DOUBLES))
def q_band_math(spark, sf):
    s = _SPEC["temperature"]
    return R.band_math(R.composite(_window(spark, sf, s.band), s.temporal), s.scale_factor, s.offset)


_SOIL_NAMES = tuple(n for _, n in TEST_CFG.soil_bands)


@register("ras_static_stack", O.sql("SELECT * FROM static_stack", "static_stack",
                                    doubles=("lon", "lat", *_SOIL_NAMES)))
def q_static_stack(spark, sf):
    return R.stack_bands(TD.static_pixels(spark, sf), TEST_CFG.soil_bands)


@register("ras_grid_snap", O.sql(
    "SELECT month, band, gx AS ix, gy AS iy, (CAST(gx AS DOUBLE) + 0.5::DOUBLE) * 0.004::DOUBLE AS lon, "
    "(CAST(gy AS DOUBLE) + 0.5::DOUBLE) * 0.004::DOUBLE AS lat, value, n_pixels FROM ("
    "SELECT month, band, CAST(floor(lon / 0.004::DOUBLE) AS BIGINT) AS gx, CAST(floor(lat / 0.004::DOUBLE) AS BIGINT) AS gy, "
    f"{O.xavg('value')} AS value, count(*) AS n_pixels FROM comp_mean GROUP BY 1, 2, 3, 4)",
    "comp_mean", doubles=_PX_DOUBLES))
def q_grid_snap(spark, sf):
    return R.snap_to_grid(R.composite(_window(spark, sf), "mean"), 0.004, keys=("month", "band"))


@register("ras_regions", O.sql(
    "SELECT region_id, field_id, x1, y1, x2, y2 FROM poly_edges", "poly_edges",
    doubles=("x1", "y1", "x2", "y2")))
def q_regions(spark, sf):
    e = SP.region_edges(regions(spark, sf))
    return e.filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))).drop("edge_no")


@register("ras_point_in_polygon", O.sql(
    "SELECT i.region_id, i.field_id, c.ix, c.iy FROM inside i JOIN "
    "(SELECT DISTINCT ix, iy FROM pixels) c ON c.ix = i.ix AND c.iy = i.iy", "inside", "pixels"))
def q_pip(spark, sf):
    cells = TD.pixels(spark, sf).select("ix", "iy", "lon", "lat").distinct()
    return SP.pixels_in_regions(cells, index(spark, sf)).select("region_id", "field_id", "ix", "iy")


@register("ras_clip", O.sql(
    "SELECT * FROM comp_mean c WHERE EXISTS (SELECT 1 FROM inside i WHERE i.ix = c.ix AND i.iy = c.iy)",
    "comp_mean", "inside", doubles=_PX_DOUBLES))
def q_clip(spark, sf):
    return SP.clip(R.composite(_window(spark, sf), "mean"), index(spark, sf), exact=True)


def _near_window(spark, sf, idx):
    """The window's pixels near a polygon, cut down before the composite is shuffled."""
    return SP.clip(_window(spark, sf), idx, exact=False)


@register("ras_zonal_mean", O.sql("SELECT * FROM zonal_mean", "zonal_mean", doubles=("value",)))
def q_zonal_mean(spark, sf):
    idx = index(spark, sf)
    return SP.zonal_stats(R.composite(_near_window(spark, sf, idx), "mean"), idx, "mean", keys=("month", "band"))


@register("ras_zonal_sum", O.sql("SELECT * FROM zonal_sum", "zonal_sum", doubles=("value",)))
def q_zonal_sum(spark, sf):
    idx = index(spark, sf)
    return SP.zonal_stats(R.composite(_near_window(spark, sf, idx), "sum"), idx, "sum", keys=("month", "band"))


def coverage(spark, sf, cfg: PipelineConfig = TEST_CFG):
    return CV.CoverageIndex.build(regions(spark, sf), cfg.cell_deg, TD.PIXEL_DEG, cfg.max_broadcast_rows, cfg.max_broadcast_bytes)


@register("ras_covered_fraction", O.sql("SELECT * FROM covered", "covered", doubles=("coverage",)))
def q_covered_fraction(spark, sf):
    places = TD.pixels(spark, sf).select("ix", "iy", "lon", "lat").distinct()
    return CV.pixels_covered(places, coverage(spark, sf)).select("region_id", "field_id", "ix", "iy", "coverage")


@register("ras_zonal_covered_mean", O.sql(
    f"SELECT i.region_id, i.field_id, c.month, c.band, {O.xsum_or_double('c.value * i.coverage')} / {O.xsum_or_double('i.coverage')} AS value FROM comp_mean c "
    "JOIN covered i ON c.ix = i.ix AND c.iy = i.iy GROUP BY i.region_id, i.field_id, c.month, c.band", "comp_mean", "covered", doubles=("value",)))
def q_zonal_covered_mean(spark, sf):
    idx = coverage(spark, sf)
    comp = R.composite(CV.clip_covered(_window(spark, sf), idx), "mean")
    return CV.zonal_covered(comp, idx, "mean", keys=("month", "band")).drop("covered_pixels")


@register("ras_zonal_soil", O.sql("SELECT * FROM zonal_soil", "zonal_soil", doubles=_SOIL_NAMES))
def q_zonal_soil(spark, sf):
    stack = R.stack_bands(TD.static_pixels(spark, sf), TEST_CFG.soil_bands)
    return SP.zonal_stats_multi(stack, index(spark, sf), _SOIL_NAMES)


@register("ras_centroid", O.sql("SELECT * FROM centroids", "centroids", doubles=("lon", "lat")))
def q_centroid(spark, sf):
    return SP.centroids(regions(spark, sf))


def job(spark, sf, name: str):
    return X.extract_series(spark, TD.pixels(spark, sf), index(spark, sf), _SPEC[name], TEST_CFG)


def job_soil(spark, sf):
    r = regions(spark, sf)
    return X.extract_static(TD.static_pixels(spark, sf), r, X.build_index(r, TEST_CFG), TEST_CFG)


for _name in ("ndvi", "temperature", "rainfall"):
    def _mk(name):
        @register(f"job_{name}", O.sql(f"SELECT * FROM job_{name}", f"job_{name}", doubles=(name,)))
        def q(spark, sf):
            return job(spark, sf, name)
        return q
    _mk(_name)


@register("job_soil", O.sql("SELECT * FROM job_soil", "job_soil", doubles=(*_SOIL_NAMES, "lat", "lon")))
def q_job_soil(spark, sf):
    return job_soil(spark, sf)


@register("set_union_months", O.sql(
    "SELECT field_id, 'ndvi' AS measure, ndvi AS value, date FROM job_ndvi UNION ALL "
    "SELECT field_id, 'temperature', temperature, date FROM job_temperature UNION ALL "
    "SELECT field_id, 'rainfall', rainfall, date FROM job_rainfall",
    "job_ndvi", "job_temperature", "job_rainfall", doubles=("value",)))
def q_union(spark, sf):
    parts = [job(spark, sf, n).select("field_id", F.lit(n).alias("measure"), F.col(n).alias("value"), "date")
             for n in ("ndvi", "temperature", "rainfall")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- sources and sinks (write to the shared scratch folder, read back) -------

from .session import scratch_path  # noqa: E402
from .sources import geojson as GJ  # noqa: E402
from .sources import tables as TB  # noqa: E402
from . import schemas as SC  # noqa: E402


def _write_polygons(spark, sf, with_id: bool) -> str:
    """Polygons derived from supplier, written as one FeatureCollection per
    nation (features ordered by supplier key)."""
    feats = TD.polygon_features(spark, sf)
    sup = TD.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("region_id"), "s_nationkey")
    feats = feats.join(sup, "region_id").withColumn("supplier", F.col("region_id").cast("string"))
    props = ["field_id", "supplier"] if with_id else ["supplier"]
    path = scratch_path(spark, "geojson")
    GJ.write_feature_collections(GJ.features_json(feats, props), path, "s_nationkey", "region_id")
    return path


def _parsed_shape(df):
    from .functions import geometry as G
    parts = G.parts_from_geojson("geom_type", "coordinates")
    box = G.bbox(parts)
    return df.select(
        "*", F.size(G.geometry_points(parts)).cast("long").alias("n_points"),
        *[v.alias(k) for k, v in box.items()])


_GEO_ORACLE_SHAPE = (
    "SELECT region_id, count(*) AS n_points, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y "
    "FROM poly_vertices GROUP BY region_id")
_BOX = ("min_x", "min_y", "max_x", "max_y")


@register("src_geojson", O.sql(
    "SELECT p.field_id, CAST(s.s_nationkey AS BIGINT) AS nation, 'Polygon' AS geom_type, "
    "CAST(p.region_id AS VARCHAR) AS supplier, v.n_points, v.min_x, v.min_y, v.max_x, v.max_y "
    f"FROM poly_params p JOIN supplier s ON s.s_suppkey = p.region_id JOIN ({_GEO_ORACLE_SHAPE}) v "
    "ON v.region_id = p.region_id", "poly_params", "poly_vertices", doubles=_BOX))
def q_src_geojson(spark, sf):
    f = GJ.read_geojson(spark, _write_polygons(spark, sf, with_id=True))
    f = f.withColumn("nation", F.regexp_extract("file", r"s_nationkey=(\d+)", 1).cast("long"))
    return _parsed_shape(f).select("field_id", "nation", "geom_type", F.col("properties")["supplier"].alias("supplier"),
                                   "n_points", *_BOX)


@register("src_geojson_default_id", O.sql(
    "SELECT 'field_' || CAST(row_number() OVER (PARTITION BY s.s_nationkey ORDER BY s.s_suppkey) - 1 AS VARCHAR) "
    "AS field_id, CAST(s.s_nationkey AS BIGINT) AS nation, CAST(s.s_suppkey AS VARCHAR) AS supplier, v.n_points "
    f"FROM supplier s JOIN ({_GEO_ORACLE_SHAPE}) v ON v.region_id = s.s_suppkey", "poly_vertices"))
def q_src_geojson_default_id(spark, sf):
    f = GJ.read_geojson(spark, _write_polygons(spark, sf, with_id=False))
    f = f.withColumn("nation", F.regexp_extract("file", r"s_nationkey=(\d+)", 1).cast("long"))
    return _parsed_shape(f).select("field_id", "nation", F.col("properties")["supplier"].alias("supplier"), "n_points")


@register("src_polygons_table", O.sql(
    "SELECT field_id, 'Polygon' AS geom_type, CAST(count(DISTINCT ring) AS BIGINT) AS n_rings "
    "FROM poly_vertices GROUP BY region_id, field_id", "poly_vertices"))
def q_src_polygons_table(spark, sf):
    path = scratch_path(spark, "cropland_polygons")
    feats = GJ.read_geojson(spark, _write_polygons(spark, sf, with_id=True))
    TB.write_replace(GJ.polygons_table(feats), path)
    t = spark.read.schema(SC.CROPLAND_POLYGONS).parquet(path)
    return t.select("field_id", F.get_json_object("geometry", "$.type").alias("geom_type"),
                    F.json_array_length(F.get_json_object("geometry", "$.coordinates")).cast("long").alias("n_rings"))


@register("sink_append", O.sql("SELECT * FROM job_ndvi", "job_ndvi", doubles=("ndvi",)))
def q_sink_append(spark, sf):
    path = scratch_path(spark, "ndvi_raw")
    rows = job(spark, sf, "ndvi")
    load = TB.load_name("suppliers", TEST_CFG.start_date, TEST_CFG.end_date)
    TB.write_append(rows, path, load)
    TB.write_append(rows, path, load)     # a rerun replaces its own rows
    return spark.read.parquet(path).select("field_id", "ndvi", F.col("date").cast("string").alias("date"))


@register("sink_append_overlap", O.sql("SELECT * FROM job_ndvi", "job_ndvi", doubles=("ndvi",)))
def q_sink_append_overlap(spark, sf):
    """Loads over a first, an overlapping later and an enclosed shorter period: the rows of one run over all of it."""
    path = scratch_path(spark, "ndvi_raw_overlap")
    idx, px = index(spark, sf), TD.pixels(spark, sf)
    for start, end in ((TEST_CFG.start_date, "1998-12-31"), ("1997-01-01", TEST_CFG.end_date), ("1996-02-01", "1996-07-01")):
        cfg = TEST_CFG.with_(start_date=start, end_date=end)
        TB.write_append(X.extract_series(spark, px, idx, _SPEC["ndvi"], cfg), path, TB.load_name("suppliers", start, end))
    return spark.read.parquet(path).select("field_id", "ndvi", F.col("date").cast("string").alias("date"))


@register("sink_ledger", O.sql(
    "SELECT polygon_set, month, CAST(count(j.date) AS BIGINT) AS n_rows, n_runs FROM ("
    "SELECT 'suppliers' AS polygon_set, strftime(month, '%Y-%m-%d') AS month, "
    "CAST(1 + CASE WHEN month >= DATE '1996-02-01' AND month < DATE '1996-07-01' THEN 1 ELSE 0 END AS BIGINT) AS n_runs FROM run_grid) g "
    "LEFT JOIN job_rainfall j ON j.date = g.month GROUP BY polygon_set, month, n_runs", "run_grid", "job_rainfall"))
def q_sink_ledger(spark, sf):
    """Who owns each month after two loads, from the ledger: the rows of its last run, and how many runs wrote it."""
    path = scratch_path(spark, "rainfall_raw_ledger")
    idx, px = index(spark, sf), TD.pixels(spark, sf)
    for start, end in ((TEST_CFG.start_date, TEST_CFG.end_date), ("1996-02-01", "1996-07-01")):
        cfg = TEST_CFG.with_(start_date=start, end_date=end)
        TB.write_append(X.extract_series(spark, px, idx, _SPEC["rainfall"], cfg), path, TB.load_name("suppliers", start, end))
    ledger = TB.read_ledger(spark, path)
    runs = ledger.groupBy("polygon_set", "month").agg(F.count_distinct("run").alias("n_runs"))
    return TB.month_owners(ledger).join(runs, ["polygon_set", "month"]).select("polygon_set", "month", F.col("rows").alias("n_rows"), "n_runs")


@register("sink_append_duplicates", O.sql(
    "SELECT * FROM job_ndvi UNION ALL SELECT * FROM job_ndvi", "job_ndvi", doubles=("ndvi",)))
def q_sink_append_dup(spark, sf):
    path = scratch_path(spark, "ndvi_raw_append")
    rows = job(spark, sf, "ndvi")
    TB.write_append(rows, path)
    TB.write_append(rows, path)    # plain append: a rerun duplicates
    return spark.read.parquet(path).select("field_id", "ndvi", F.col("date").cast("string").alias("date"))


@register("sink_replace", O.sql("SELECT * FROM job_soil", "job_soil", doubles=(*_SOIL_NAMES, "lat", "lon")))
def q_sink_replace(spark, sf):
    path = scratch_path(spark, "soil_raw")
    rows = job_soil(spark, sf)
    TB.write_replace(rows, path)
    TB.write_replace(rows, path)
    return spark.read.schema(SC.SOIL_RAW).parquet(path)


@register("raw_series_rows", O.sql(
    "SELECT field_id, value, strftime(month, '%Y-%m-%d') AS date FROM zonal_sum WHERE band = 'R' "
    "AND field_id IS NOT NULL AND field_id <> '' AND value IS NOT NULL", "zonal_sum", doubles=("value",)))
def q_raw_series_rows(spark, sf):
    idx = index(spark, sf)
    comp = R.composite(SP.clip(_window(spark, sf, "R"), idx, exact=False), "sum")
    return X.series_rows(SP.zonal_stats(comp, idx, "sum"), "value")


@register("raw_soil_rows", O.sql(
    "SELECT c.field_id, c.lat, c.lon, z.soil_ph, z.clay FROM centroids c LEFT JOIN zonal_soil z ON c.region_id = z.region_id "
    "WHERE c.field_id IS NOT NULL AND c.field_id <> ''", "centroids", "zonal_soil", doubles=("lat", "lon", "soil_ph", "clay")))
def q_raw_soil_rows(spark, sf):
    return job_soil(spark, sf).select("field_id", "lat", "lon", "soil_ph", "clay")


# ---- end-to-end build, reports, checks ---------------------------------------

from .plans import pipeline as PL  # noqa: E402
from .plans import quality as QC  # noqa: E402
from .plans import reports as RP  # noqa: E402


@register("pipeline_build_all", O.sql("SELECT * FROM b_assessment", "b_assessment", doubles=ASSESS_DOUBLES))
def q_build_all(spark, sf):
    root = scratch_path(spark, "build")
    rep = PL.build_all(spark, TEST_CFG, TD.polygon_features(spark, sf), TD.pixels(spark, sf),
                       TD.static_pixels(spark, sf), seed_thresholds(spark), root=root)
    return rep["layout"].read(spark, "marts", "assessment_dataset")


@register("report_spatial", O.sql(
    "SELECT CAST(floor(l.latitude / 1.0::DOUBLE) AS BIGINT) AS cell_lat, "
    "CAST(floor(l.longitude / 1.0::DOUBLE) AS BIGINT) AS cell_lon, count(*) AS n_fields, "
    + O.xavg("f.field_score") + " AS avg_total_score, min(f.field_score) AS min_field_score, "
    "max(f.field_score) AS max_field_score FROM (SELECT field_id, " + O.xavg("total_suitability_score") + " AS field_score "
    "FROM fact GROUP BY field_id) f JOIN dim_location l ON f.field_id = l.field_id GROUP BY 1, 2",
    "fact", "dim_location", doubles=("avg_total_score", "min_field_score", "max_field_score")))
def q_report_spatial(spark, sf):
    return RP.report_spatial(fact(spark, sf), M.dim_location(stg_inputs(spark, sf)[3]))


_SOIL_MEAN_SQL = "(" + " + ".join(f"{s}_score" for s in SOIL_FEATURES) + f") / {O.dbl(5)}"


@register("report_factors", O.sql(
    f"SELECT agricultural_period, factor, {O.xavg('score')} AS avg_score, {O.xavg('contribution')} AS avg_contribution FROM ("
    + " UNION ALL ".join(
        f"SELECT agricultural_period, '{n}' AS factor, {('(' + _SOIL_MEAN_SQL + ')') if n == 'soil' else n + '_score'} "
        f"AS score, {('(' + _SOIL_MEAN_SQL + ')') if n == 'soil' else n + '_score'} * {O.dbl(w)} AS contribution "
        "FROM fact" for n, w in (("temperature", 0.4), ("rainfall", 0.3), ("ndvi", 0.2), ("soil", 0.1)))
    + ") GROUP BY agricultural_period, factor", "fact", doubles=("avg_score", "avg_contribution")))
def q_report_factors(spark, sf):
    return RP.report_factors(fact(spark, sf))


@register("report_trends", O.sql(
    "SELECT CAST(extract(year FROM date) AS BIGINT) AS year, agricultural_period, count(*) AS n_rows, "
    f"{O.xavg('ndvi')} AS avg_ndvi, {O.xavg('temperature')} AS avg_temperature, {O.xavg('rainfall')} AS avg_rainfall, "
    f"{O.xavg('total_suitability_score')} AS avg_total_score FROM fact GROUP BY ALL", "fact",
    doubles=("avg_ndvi", "avg_temperature", "avg_rainfall", "avg_total_score")))
def q_report_trends(spark, sf):
    return RP.report_trends(fact(spark, sf))


_IN_RANGE = " AND ".join(f"{c} BETWEEN 0.0::DOUBLE AND 1.0::DOUBLE" for c in
                         [f"{f}_score" for f in SEASONAL_FEATURES + SOIL_FEATURES] + ["total_suitability_score"])


@register("quality_checks", O.sql(
    "SELECT 'fact_unique_field_date' AS \"check\", CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS failing FROM "
    "(SELECT count(*) AS n FROM fact GROUP BY field_id, date HAVING count(*) > 1) UNION ALL "
    "SELECT 'fact_not_null_keys', CAST(count(*) FILTER (WHERE field_id IS NULL OR date IS NULL) AS BIGINT) FROM fact "
    "UNION ALL SELECT 'fact_season_accepted', CAST(count(*) FILTER (WHERE NOT coalesce(agricultural_period IN "
    "('germination_early_growth', 'vegetative_growth', 'sugar_accumulation', 'other_period'), false)) AS BIGINT) "
    f"FROM fact UNION ALL SELECT 'fact_scores_in_unit_range', CAST(count(*) FILTER (WHERE NOT coalesce({_IN_RANGE}, "
    "false)) AS BIGINT) FROM fact UNION ALL SELECT 'fact_field_in_dim_location', CAST(count(*) AS BIGINT) FROM "
    "(SELECT DISTINCT field_id FROM fact) f WHERE NOT EXISTS (SELECT 1 FROM dim_location l WHERE l.field_id = f.field_id) "
    "UNION ALL SELECT 'thresholds_unique_feature_period', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
    "(SELECT count(*) AS n FROM thresholds GROUP BY feature, period HAVING count(*) > 1) UNION ALL "
    "SELECT 'dim_location_unique_field', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
    "(SELECT count(*) AS n FROM dim_location GROUP BY field_id HAVING count(*) > 1)",
    "fact", "thresholds", "dim_location"))
def q_quality(spark, sf):
    return QC.quality_checks(fact(spark, sf), seed_thresholds(spark), M.dim_location(stg_inputs(spark, sf)[3]))
