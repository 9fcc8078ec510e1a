from terrascore.__main__ import main
from terrascore.plans import testdata as TD
from terrascore.session import scratch_path
from terrascore.sources import geojson as GJ
from terrascore.sources.tables import seed_thresholds, write_pixels, write_thresholds_csv

SF = "/root/testdata/sf0.001"


def test_build_from_stored_inputs(spark):
    poly, px, st, th, root = (scratch_path(spark, n) for n in ("cli-poly", "cli-px", "cli-st", "cli-th", "cli-root"))
    feats = TD.polygon_features(spark, SF)
    GJ.write_feature_collections(GJ.features_json(feats, ["field_id"]), poly, "geom_type", "region_id")
    write_pixels(TD.pixels(spark, SF), px)
    TD.static_pixels(spark, SF).write.parquet(st)
    write_thresholds_csv(seed_thresholds(spark), th)
    series = [f"{s.name}:{s.band}:{s.temporal}:{s.zonal}:{s.scale_factor!r}:{s.offset!r}" for s in TD.TEST_SERIES]
    argv = ["build", "--polygons", poly, "--pixels", px, "--static-pixels", st, "--thresholds", th,
            "--start", "1995-01-01", "--end", "2001-12-31", "--root", root, "--cell-deg", "0.005"]
    for s in series:
        argv += ["--series", s]
    summary = main(argv, spark)
    assert summary["cropland_polygons"] == 10 and summary["ndvi_raw"] > 0
    assert spark.read.parquet(f"{root}/marts/assessment_dataset").count() > 0
