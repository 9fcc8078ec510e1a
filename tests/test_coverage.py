"""Covered fractions: against sampled squares, and their sum against the polygon's area."""

import json

import pytest
from pyspark.sql import functions as F

from terrascore.operators import coverage as CV
from terrascore.operators import spatial as SP

STAR = [[[2.0, 1.0], [2.6, 2.4], [4.0, 2.5], [2.9, 3.4], [3.3, 4.9], [2.0, 4.0], [0.7, 4.9], [1.1, 3.4], [0.0, 2.5], [1.4, 2.4], [2.0, 1.0]],
        [[1.7, 2.7], [2.3, 2.7], [2.3, 3.3], [1.7, 3.3], [1.7, 2.7]]]
BACK = [ring[::-1] for ring in STAR]


def _shoelace(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))) / 2


def _grid(spark, size, n):
    return (spark.range(n * n).select((F.col("id") % n).alias("ix"), F.floor(F.col("id") / n).alias("iy"))
            .withColumn("lon", (F.col("ix") + 0.5) * size - 1).withColumn("lat", (F.col("iy") + 0.5) * size - 1))


@pytest.mark.parametrize("cell,max_rows", [(0.3, 1_000_000), (0.3, 1), (7.0, 1_000_000)])
def test_shares_add_up_to_the_area(spark, cell, max_rows):
    feats = spark.createDataFrame([(0, "star", "Polygon", json.dumps(STAR)), (1, "back", "Polygon", json.dumps(BACK)),
                                   (2, "both", "MultiPolygon", json.dumps([STAR, [[[5, 5], [5.7, 5], [5.7, 5.1], [5, 5.1], [5, 5]]]])), (3, "none", None, None)],
                                  "region_id long, field_id string, geom_type string, coordinates string")
    idx = CV.CoverageIndex.build(SP.regions(feats), cell, 0.17, max_rows)
    assert idx.broadcastable == (max_rows > 1)
    rows = CV.pixels_covered(_grid(spark, 0.17, 45), idx).collect()
    area = _shoelace(STAR[0]) - _shoelace(STAR[1])
    sums = {f: sum(r.coverage for r in rows if r.field_id == f) * 0.17 ** 2 for f in ("star", "back", "both")}
    assert sums["star"] == pytest.approx(area, abs=1e-9) and sums["back"] == pytest.approx(area, abs=1e-9)
    assert sums["both"] == pytest.approx(area + 0.07, abs=1e-9)
    assert all(0 < r.coverage <= 1 for r in rows) and {r.field_id for r in rows} == {"star", "back", "both"}


def test_shares_equal_sampled_squares(spark):
    """Each square against 40 x 40 points tested one by one."""
    feats = spark.createDataFrame([(0, "star", "Polygon", json.dumps(STAR))], "region_id long, field_id string, geom_type string, coordinates string")
    idx = CV.CoverageIndex.build(SP.regions(feats), 0.5, 0.5, 1_000_000)
    got = {(r.ix, r.iy): r.coverage for r in CV.pixels_covered(_grid(spark, 0.5, 14), idx).collect()}
    edges = [(*a, *b) for ring in STAR for a, b in zip(ring, ring[1:], strict=False)]

    def inside(x, y):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in edges) % 2

    for ix in range(14):
        for iy in range(14):
            points = [inside(ix * 0.5 - 1 + (a + 0.5) / 80, iy * 0.5 - 1 + (b + 0.5) / 80) for a in range(40) for b in range(40)]
            assert got.get((ix, iy), 0.0) == pytest.approx(sum(points) / 1600, abs=0.03)


def test_weighted_zonal_mean_and_sum(spark):
    half = [[[0.5, 0.0], [2.0, 0.0], [2.0, 1.0], [0.5, 1.0], [0.5, 0.0]]]
    feats = spark.createDataFrame([(0, "h", "Polygon", json.dumps(half))], "region_id long, field_id string, geom_type string, coordinates string")
    px = spark.createDataFrame([("m", 0, 0, 0.5, 0.5, 10.0), ("m", 1, 0, 1.5, 0.5, 40.0), ("m", 2, 0, 2.5, 0.5, 99.0)],
                               "month string, ix int, iy int, lon double, lat double, value double")
    idx = CV.CoverageIndex.build(SP.regions(feats), 0.4, 1.0, 1_000_000)
    mean, total = (CV.zonal_covered(px, idx, kind).first() for kind in ("mean", "sum"))
    assert mean.value == pytest.approx(30.0) and total.value == pytest.approx(45.0) and mean.covered_pixels == pytest.approx(1.5)


def test_a_share_is_worked_out_once_a_place(spark, monkeypatch):
    """Months and bands of a place share its covered shares; a place whose centre differs in one month has its own."""
    half = [[[0.5, 0.0], [2.0, 0.0], [2.0, 1.0], [0.5, 1.0], [0.5, 0.0]]]
    feats = spark.createDataFrame([(0, "h", "Polygon", json.dumps(half))], "region_id long, field_id string, geom_type string, coordinates string")
    rows = [(f"m{m}", x, 0, x + 0.5, 0.5, 10.0 * (m + 1) * (x + 1)) for m in range(20) for x in range(2)]
    rows += [("m20", 0, 0, 0.75, 0.5, 8.0), ("m20", 1, 0, 1.5, 0.5, 4.0), ("m20", 1, 0, 1.5, 0.5, None), ("m21", 1, 0, None, 0.5, 1.0)]
    px = spark.createDataFrame(rows, "month string, ix int, iy int, lon double, lat double, value double")
    idx = CV.CoverageIndex.build(SP.regions(feats), 0.4, 1.0, 1_000_000)
    places, covered = [], CV.pixels_covered
    monkeypatch.setattr(CV, "pixels_covered", lambda p, *rest: places.append(p.count()) or covered(p, *rest))
    got = {r.month: (r.value, r.covered_pixels) for r in CV.zonal_covered(px, idx, "mean").collect()}
    assert places == [4]  # of 44 rows
    assert got == {f"m{m}": (pytest.approx((m + 1) * 10 * (0.5 + 2) / 1.5), 1.5) for m in range(20)} | {"m20": (pytest.approx((8 * 0.75 + 4) / 1.75), 2.75)}
    plan = CV.pixels_covered(px, idx)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("least(greatest((-aggregate(") == 1


def test_a_series_of_covered_shares(spark):
    """The extraction job of a source with a pixel size: weights are filled in, and a field smaller than a pixel gets its value."""
    from terrascore.config import PipelineConfig, SourceSpec
    from terrascore.plans.extract import build_index, extract_series
    rings = {"h": [[[0.5, 0.0], [2.0, 0.0], [2.0, 1.0], [0.5, 1.0], [0.5, 0.0]]], "tiny": [[[2.1, 0.1], [2.2, 0.1], [2.2, 0.2], [2.1, 0.1]]]}
    feats = spark.createDataFrame([(i, f, "Polygon", json.dumps(r)) for i, (f, r) in enumerate(rings.items())],
                                  "region_id long, field_id string, geom_type string, coordinates string")
    px = (spark.createDataFrame([(0, 0, 0.5, 0.5, 10.0), (1, 0, 1.5, 0.5, 40.0), (2, 0, 2.5, 0.5, 99.0)], "ix int, iy int, lon double, lat double, value double")
          .withColumn("band", F.lit("A")).withColumn("image_date", F.to_date(F.lit("2020-03-05"))))
    cfg = PipelineConfig(start_date="2020-01-01", end_date="2020-12-31", cell_deg=0.4)
    idx = build_index(SP.regions(feats), cfg)
    rows = {r.field_id: r.v for r in extract_series(spark, px, idx, SourceSpec("v", band="A", pixel_deg=1.0), cfg).collect()}
    assert rows == {"h": pytest.approx(30.0), "tiny": pytest.approx(99.0)}
    assert {r.field_id for r in extract_series(spark, px, idx, SourceSpec("v", band="A"), cfg).collect()} == {"h"}
    with pytest.raises(ValueError):
        SourceSpec("v", band="A", pixel_deg=1.0, weight="w")
