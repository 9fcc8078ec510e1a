import json

import pytest
from pyspark.sql import functions as F

from terrascore.functions.geometry import point_in_polygon
from terrascore.operators import coverage as CV
from terrascore.operators import raster as R
from terrascore.operators import spatial as SP
from terrascore.plans import testdata as TD

SF = "/root/testdata/sf0.001"


def _features(spark, polys):
    rows = [(i, fid, gtype, json.dumps(coords)) for i, (fid, gtype, coords) in enumerate(polys)]
    return spark.createDataFrame(rows, "region_id long, field_id string, geom_type string, coordinates string")


SQUARE = [[[-8.8, 30.5], [-8.7, 30.5], [-8.7, 30.6], [-8.8, 30.6], [-8.8, 30.5]]]
HOLED = [[[-8.8, 30.4], [-8.3, 30.4], [-8.3, 30.9], [-8.8, 30.9], [-8.8, 30.4]],
         [[-8.7, 30.5], [-8.6, 30.5], [-8.6, 30.6], [-8.7, 30.6], [-8.7, 30.5]]]


def test_centroid_of_square(spark):
    c = SP.centroids(SP.regions(_features(spark, [("plot_a", "Polygon", SQUARE)]))).first()
    assert round(c.lon, 9) == -8.75 and round(c.lat, 9) == 30.55


def test_centroid_subtracts_hole(spark):
    c = SP.centroids(SP.regions(_features(spark, [("h", "Polygon", HOLED)]))).first()
    # outer 0.25 area centred at (-8.55, 30.65), hole 0.01 centred at (-8.65, 30.55)
    assert c.lon == pytest.approx((-8.55 * 0.25 + 8.65 * 0.01) / 0.24)
    assert c.lat == pytest.approx((30.65 * 0.25 - 30.55 * 0.01) / 0.24)


def test_hole_and_multipolygon(spark):
    multi = [SQUARE, [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]]
    r = SP.regions(_features(spark, [("h", "Polygon", HOLED), ("m", "MultiPolygon", multi)]))
    pts = spark.createDataFrame([(-8.65, 30.55), (-8.45, 30.55), (0.5, 0.5), (-8.75, 30.55), (5.0, 5.0)],
                                "x double, y double")
    got = pts.crossJoin(r).select("x", "y", "field_id", point_in_polygon("x", "y", "edges").alias("inside"))
    inside = {(row.x, row.y, row.field_id) for row in got.collect() if row.inside}
    assert inside == {(-8.45, 30.55, "h"), (0.5, 0.5, "m"), (-8.75, 30.55, "m"), (-8.75, 30.55, "h")}


@pytest.mark.parametrize("cell", [0.03, 0.1, 0.5])
def test_cell_index_join_equals_brute_force(spark, cell):
    regions = SP.regions(TD.polygon_features(spark, SF))
    cells = TD.pixels(spark, SF).select("ix", "iy", "lon", "lat").distinct()
    idx = SP.SpatialIndex.build(regions, cell, max_rows=1_000_000)
    fast = {tuple(r) for r in SP.pixels_in_regions(cells, idx).select("region_id", "ix", "iy").collect()}
    brute = cells.crossJoin(regions.select("region_id", "edges")).filter(
        point_in_polygon("lon", "lat", "edges")).select("region_id", "ix", "iy")
    assert fast == {tuple(r) for r in brute.collect()}
    assert len(fast) > 0


def test_unbroadcast_index_same_result(spark):
    regions = SP.regions(TD.polygon_features(spark, SF))
    cells = TD.pixels(spark, SF).select("ix", "iy", "lon", "lat").distinct()
    a = SP.SpatialIndex.build(regions, 0.1, max_rows=1_000_000)
    b = SP.SpatialIndex.build(regions, 0.1, max_rows=1)
    assert a.broadcastable and not b.broadcastable
    ka = {tuple(r) for r in SP.pixels_in_regions(cells, a).select("region_id", "ix", "iy").collect()}
    kb = {tuple(r) for r in SP.pixels_in_regions(cells, b).select("region_id", "ix", "iy").collect()}
    assert ka == kb


def test_no_pixels_no_row_and_coarse_clip_superset(spark):
    far = [("off", "Polygon", [[[10, 10], [11, 10], [11, 11], [10, 10]]])]
    r = SP.regions(_features(spark, far + [("sq", "Polygon", SQUARE)]))
    idx = SP.SpatialIndex.build(r, 0.1, max_rows=10_000)
    px = TD.pixels(spark, SF).filter(F.col("band") == "A")
    z = SP.zonal_stats(px.withColumn("month", F.trunc("image_date", "MM")), idx, "mean")
    assert {row.field_id for row in z.collect()} <= {"sq"}
    assert SP.clip(px, idx, exact=True).count() <= SP.clip(px, idx, exact=False).count()


def test_centres_that_move_are_tested_where_they_are(spark):
    """A location whose centre differs between months: each row is tested at its own centre."""
    regions = SP.regions(_features(spark, [("sq", "Polygon", [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]])]))
    rows = [("2020-01-01", 0, 0, 0.5, 0.5, 1.0), ("2020-02-01", 0, 0, 5.0, 0.5, 2.0), ("2020-03-01", 0, 0, 0.6, 0.5, 3.0)]
    px = spark.createDataFrame(rows, "month string, ix int, iy int, lon double, lat double, value double")
    for max_rows in (1, 1_000_000):
        idx = SP.SpatialIndex.build(regions, 0.25, max_rows=max_rows)
        assert sorted((r.month, r.value) for r in SP.zonal_stats(px, idx, "sum").collect()) == [("2020-01-01", 1.0), ("2020-03-01", 3.0)]


def test_bands_are_kept_apart(spark):
    rows = [("2020-01-01", "a", 0, 0, 10.0), ("2020-01-01", "b", 0, 0, 2.0), ("2020-01-01", "b", 0, 0, 4.0)]
    px = spark.createDataFrame(rows, "month string, band string, ix int, iy int, value double").withColumn("lon", F.lit(0.5)).withColumn("lat", F.lit(0.5))
    assert {(r.band, r.value) for r in R.composite(px, "mean").collect()} == {("a", 10.0), ("b", 3.0)}


def test_soil_rows_keep_polygons_without_pixels_or_geometry(spark):
    from terrascore import catalog
    from terrascore.plans.extract import extract_static
    # at sf0.001 the static soil grid covers the first blocks only
    south = [[[-9.0, 30.0], [-8.9, 30.0], [-8.9, 30.1], [-9.0, 30.1], [-9.0, 30.0]]]
    feats = spark.createDataFrame(
        [(0, "sq", "Polygon", json.dumps(south)), (1, "far", "Polygon", json.dumps([[[10, 10], [11, 10], [11, 11], [10, 10]]])),
         (2, "nogeom", None, None), (3, "", "Polygon", json.dumps(SQUARE)), (4, None, "Polygon", json.dumps(SQUARE)),
         (5, "line", "LineString", json.dumps([[0, 0], [1, 1]]))],
        "region_id long, field_id string, geom_type string, coordinates string")
    r = SP.regions(feats)
    idx = SP.SpatialIndex.build(r, 0.1, max_rows=10_000)
    rows = {x.field_id: x for x in extract_static(TD.static_pixels(spark, SF), r, idx, catalog.TEST_CFG).collect()}
    assert set(rows) == {"sq", "far", "nogeom", "line"}          # empty / null ids dropped
    assert rows["sq"].soil_ph is not None and round(rows["sq"].lon, 9) == -8.95 and round(rows["sq"].lat, 9) == 30.05
    assert rows["far"].soil_ph is None and rows["far"].lat == pytest.approx(10 + 1 / 3)
    assert rows["nogeom"].lat is None and rows["nogeom"].soil_ph is None
    assert rows["line"].lat is None


def test_weighted_zonal(spark):
    regions = SP.regions(TD.polygon_features(spark, SF))
    idx = SP.SpatialIndex.build(regions, 0.1, max_rows=1_000_000)
    px = TD.pixels(spark, SF).filter(F.col("band") == "N").withColumn("month", F.trunc("image_date", "MM"))
    half = px.withColumn("w", F.lit(0.5))
    plain_mean = {(r.region_id, r.month): r.value for r in SP.zonal_stats(px, idx, "mean").collect()}
    w_mean = {(r.region_id, r.month): r.value for r in SP.zonal_stats(half, idx, "mean", weight="w").collect()}
    plain_sum = {(r.region_id, r.month): r.value for r in SP.zonal_stats(px, idx, "sum").collect()}
    w_sum = {(r.region_id, r.month): r.value for r in SP.zonal_stats(half, idx, "sum", weight="w").collect()}
    assert plain_mean.keys() == w_mean.keys() and len(plain_mean) > 0
    assert all(w_mean[k] == pytest.approx(plain_mean[k]) for k in plain_mean)
    assert all(w_sum[k] == pytest.approx(plain_sum[k] / 2) for k in plain_sum)


def test_many_polygons_make_many_cells(spark):
    """More polygons than the broadcast bound: the cells stay small, the join is a shuffle join, the rows the same."""
    regions = SP.regions(TD.polygon_features(spark, "/root/testdata/sf0.01"))
    n = regions.count()
    idx = SP.SpatialIndex.build(regions, 0.005, max_rows=n // 4)
    assert not idx.broadcastable and idx.cell_deg == 0.005
    assert idx.df.select("cx", "cy").distinct().count() > 2 * n
    cells = TD.pixels(spark, "/root/testdata/sf0.01").select("ix", "iy", "lon", "lat").distinct()
    plain = SP.SpatialIndex.build(regions, 0.02, max_rows=1_000_000)
    got = [{tuple(r) for r in SP.pixels_in_regions(cells, i).select("region_id", "ix", "iy").collect()} for i in (idx, plain)]
    assert got[0] == got[1] and len(got[0]) > n


def test_soil_is_clipped_before_its_shuffle(spark):
    from terrascore import catalog
    plan = catalog.QUERIES["job_soil"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    semi = plan.index("LeftSemi")
    assert "Aggregate [ix" in plan[:semi] and "Aggregate [ix" not in plan[semi:]


def test_the_index_is_worked_out_once_by_many_tasks(spark, monkeypatch):
    """Polygons read by one task are dealt out, and no use of an index parses them again."""
    ring = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    feats = spark.createDataFrame([(i, f"f{i}", "Polygon", json.dumps(ring)) for i in range(40)],
                                  "region_id long, field_id string, geom_type string, coordinates string").coalesce(1)
    regions = SP.regions(feats)
    assert len([n for n in regions.groupBy(F.spark_partition_id()).count().collect()]) > 1
    for index in (SP.SpatialIndex.build(regions, 1.0, 1_000_000), CV.CoverageIndex.build(regions, 1.0, 0.5, 1_000_000)):
        plan = index.df._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "filter(" not in plan
        assert index.df.select("region_id").distinct().count() == 40
