import json
import os

import pytest

from pyspark.sql import functions as F

from terrascore.operators import raster as R
from terrascore.plans import testdata as TD
from terrascore.session import local_path, scratch_path
from terrascore.sources import geojson as GJ
from terrascore.sources import tables as TB
from terrascore import schemas

SF = "/root/testdata/sf0.001"


def test_monthly_sums_add_up_to_range_total(spark):
    px = R.band_select(TD.pixels(spark, SF), "R")
    w = R.month_window(R.date_range(px, "1995-01-01", "2001-12-31"), R.month_grid(spark, "1995-01-01", "2001-12-31"))
    comp = R.composite(w, "sum")
    total = R.date_range(px, "1995-01-01", "2001-12-31").agg(F.sum("value")).first()[0]
    assert comp.agg(F.sum("value")).first()[0] == total


def test_end_date_exclusive(spark):
    px = TD.pixels(spark, SF)
    last = px.agg(F.max("image_date")).first()[0]
    assert R.date_range(px, "1990-01-01", last.isoformat()).filter(F.col("image_date") == last).count() == 0


def test_empty_months_are_grid_minus_seen(spark):
    px = TD.pixels(spark, SF)
    grid = R.month_grid(spark, "1994-01-01", "2002-12-31")
    empty = R.empty_months(px, "1994-01-01", "2002-12-31")
    n_bands = px.select("band").distinct().count()
    seen = px.select("band", F.trunc("image_date", "MM").alias("m")).distinct().count()
    assert empty.count() == n_bands * grid.count() - seen


def test_band_math_after_composite(spark):
    px = R.band_select(TD.pixels(spark, SF), "N").withColumn("month", F.trunc("image_date", "MM"))
    comp = R.band_math(R.composite(px, "mean"), offset=-273.15)
    raw = R.composite(px, "mean")
    a = {(r.month, r.ix, r.iy): r.value for r in comp.collect()}
    b = {(r.month, r.ix, r.iy): r.value - 273.15 for r in raw.collect()}
    assert a == b


def test_stack_and_snap(spark):
    st = R.stack_bands(TD.static_pixels(spark, SF), TD.SOIL_BANDS if hasattr(TD, "SOIL_BANDS") else
                       (("phh2o", "soil_ph"), ("cec", "soil_cec"), ("clay", "clay"), ("silt", "silt"), ("sand", "sand")))
    assert set(st.columns) >= {"ix", "iy", "soil_ph", "sand"}
    snapped = R.snap_to_grid(st.withColumnRenamed("soil_ph", "value"), 0.5)
    assert snapped.agg(F.sum("n_pixels")).first()[0] == st.count()


def _write_fc(path, features):
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh)


def _feat(props, coords):
    return {"type": "Feature", "properties": props, "geometry": {"type": "Polygon", "coordinates": coords}}


SQ = [[[-8.8, 30.5], [-8.7, 30.5], [-8.7, 30.6], [-8.8, 30.6], [-8.8, 30.5]]]


def test_geojson_ids(spark):
    d = local_path(scratch_path(spark, "gj-test"))
    os.makedirs(d, exist_ok=True)
    _write_fc(f"{d}/noid.geojson", [_feat({"name": "a"}, SQ), _feat({}, SQ)])
    got = sorted(r.field_id for r in GJ.read_geojson(spark, f"{d}/noid.geojson").collect())
    assert got == ["field_0", "field_1"]
    _write_fc(f"{d}/partial.geojson", [_feat({"field_id": "x1"}, SQ), _feat({"name": "b"}, SQ)])
    got = [r.field_id for r in GJ.read_geojson(spark, f"{d}/partial.geojson").orderBy("feature_index").collect()]
    assert got == ["x1", None]
    both = GJ.read_geojson(spark, [f"{d}/noid.geojson", f"{d}/partial.geojson"])
    assert both.select("region_id").distinct().count() == 4


def test_polygons_table_round_trip(spark):
    d = local_path(scratch_path(spark, "gj-test2"))
    os.makedirs(d, exist_ok=True)
    _write_fc(f"{d}/one.geojson", [_feat({"field_id": "plot_a"}, SQ)])
    t = GJ.polygons_table(GJ.read_geojson(spark, f"{d}/one.geojson")).first()
    assert t.field_id == "plot_a"
    assert json.loads(t.geometry) == {"type": "Polygon", "coordinates": SQ}


def test_sinks(spark):
    rows = spark.createDataFrame([("a", 0.5, "2020-01-01"), ("b", 0.2, "2020-02-01")], schemas.NDVI_RAW)
    p = scratch_path(spark, "sink-idem")
    north, south = TB.load_name("north fields", "2020-01-01", "2020-12-31"), TB.load_name("south fields", "2020-01-01", "2020-12-31")
    TB.write_append(rows, p, north)
    TB.write_append(rows.withColumn("field_id", F.lit("s")), p, south)          # another set, the same months: both stay
    TB.write_append(rows.filter("field_id = 'a'"), p, north)                    # a rerun without February drops it
    back = sorted((r.field_id, str(r.date)) for r in spark.read.parquet(p).collect())
    assert back == [("a", "2020-01-01"), ("s", "2020-01-01"), ("s", "2020-02-01")]
    p2 = scratch_path(spark, "sink-append")
    TB.write_append(rows, p2)
    TB.write_append(rows, p2)
    assert spark.read.parquet(p2).count() == 4
    p3 = scratch_path(spark, "sink-replace")
    TB.write_replace(rows, p3)
    TB.write_replace(rows, p3)
    assert spark.read.parquet(p3).count() == 2


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("catalog", [False, True])
def test_overlapping_loads_give_the_rows_of_one_run(spark, mode, catalog):
    """Longer, shorter and overlapping loads, months that become empty, both overwrite modes, folder and catalog table."""
    months = [f"{y}-{m:02d}-01" for y in (2020, 2021) for m in range(1, 13)]
    rows = lambda start, end, value, skip=(): spark.createDataFrame(
        [(f, value, m) for f in "ab" for m in months if start <= m < end and m not in skip], schemas.NDVI_RAW)
    name = f"default.overlap_{mode}" if catalog else scratch_path(spark, "sink-overlap")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for start, end, value, skip in (("2020-01-01", "2020-12-31", 1.0, ()), ("2020-06-01", "2021-04-01", 2.0, ()), ("2020-02-01", "2020-04-01", 3.0, ("2020-03-01",)),
                                        ("2020-02-01", "2020-04-01", 3.0, ("2020-03-01",))):
            TB.write_append(rows(start, end, value, skip), name, TB.load_name("one", start, end))
        TB.write_append(rows("2020-01-01", "2020-03-01", 9.0), name, TB.load_name("two", "2020-01-01", "2020-03-01"))
        TB.write_append(rows("2020-01-01", "2020-01-01", 0.0), name, TB.load_name("none", "2020-01-01", "2020-03-01"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    want = {("one", m): v for m in months[:15] for v in [3.0 if m == "2020-02-01" else 1.0 if m < "2020-06-01" else 2.0] if m != "2020-03-01"}
    want |= {("two", m): 9.0 for m in months[:2]}
    got = TB.read_table(spark, name).collect()
    assert len(got) == 2 * len(want) and {(r.polygon_set, str(r.date)): r.ndvi for r in got} == want
    owners = {(r.polygon_set, r.month): r.rows for r in TB.month_owners(TB.read_ledger(spark, name)).collect()}
    assert owners == {k: 2 for k in want} | {("one", "2020-03-01"): 0, ("none", "2020-01-01"): 0, ("none", "2020-02-01"): 0}
    assert TB.read_ledger(spark, name).select("run").distinct().count() == 6


def test_a_row_outside_of_the_load_fails(spark):
    rows = spark.createDataFrame([("a", 0.5, "2020-05-01")], schemas.NDVI_RAW)
    with pytest.raises(Exception, match="does not own"):
        TB.write_append(rows, scratch_path(spark, "sink-strange"), TB.load_name("s", "2020-01-01", "2020-05-01"))
    assert TB.load_name("s", "2020-01-15", "2020-04-01").months() == ["2020-02-01", "2020-03-01"]


def test_broken_polygon_file_fails(spark):
    d = local_path(scratch_path(spark, "gj-broken"))
    os.makedirs(d, exist_ok=True)
    _write_fc(f"{d}/good.geojson", [_feat({"field_id": "g"}, SQ)])
    with open(f"{d}/good.geojson") as good, open(f"{d}/broken.geojson", "w") as out:
        out.write(good.read()[:60])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        GJ.read_geojson(spark, d).collect()


def test_field_ids_stay_distinct_for_many_suppliers(spark):
    keys = spark.range(20_000).select(TD.field_key("id").alias("f"))
    assert keys.distinct().count() == 20_000


def test_threshold_csv_keeps_doubles(spark):
    p = scratch_path(spark, "thr")
    TB.write_thresholds_csv(TB.seed_thresholds(spark), p)
    t = TB.read_thresholds_csv(spark, p)
    assert dict(t.dtypes)["optimal_min"] == "double" and t.count() == 14


def test_feature_collection_writer_splits_large_keys(spark):
    from pyspark.sql import functions as F
    feats = TD.polygon_features(spark, "/root/testdata/sf0.01").withColumn("grp", F.lit(1))
    path = scratch_path(spark, "fc-split")
    GJ.write_feature_collections(GJ.features_json(feats, ["field_id"]), path, "grp", "region_id",
                                 max_features_per_file=30)
    chunks = [c for c in os.listdir(local_path(path) + "/grp=1") if c.startswith("chunk=")]
    files = [f for c in chunks for f in os.listdir(f"{local_path(path)}/grp=1/{c}") if not f.startswith((".", "_"))]
    assert len(chunks) == len(files) == 4                    # ceil(100 / 30) hash-split files, one document each
    back = GJ.read_geojson(spark, path)
    assert back.count() == 100 and back.select("field_id").distinct().count() == 100
    assert back.select("region_id").distinct().count() == 100


def test_month_partitioned_layout_prunes_band_and_month(spark):
    src = scratch_path(spark, "layout")
    TB.write_pixels(TD.pixels(spark, SF), src)
    df = TB.read_pixels(spark, src, "1996-03-15", "1996-06-01", band="A")
    plan = df._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.find("PartitionFilters"):plan.find("PushedFilters")]
    assert "(band" in part and "(month" in part
    want = TD.pixels(spark, SF).filter("band = 'A' AND image_date >= '1996-03-15' AND image_date < '1996-06-01'")
    assert df.count() == want.count() > 0


def test_multipolygon_file_to_regions(spark):
    from terrascore.operators import spatial as SP
    from terrascore.functions.geometry import point_in_polygon
    d = local_path(scratch_path(spark, "gj-multi"))
    os.makedirs(d, exist_ok=True)
    parts = [SQ, [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]]
    feat = {"type": "Feature", "properties": {"field_id": "m1"},
            "geometry": {"type": "MultiPolygon", "coordinates": parts}}
    _write_fc(f"{d}/multi.geojson", [feat])
    f = GJ.read_geojson(spark, f"{d}/multi.geojson")
    r = SP.regions(f)
    pts = spark.createDataFrame([(0.5, 0.5), (-8.75, 30.55), (5.0, 5.0)], "x double, y double")
    got = {(row.x, row.y) for row in pts.crossJoin(r).filter(point_in_polygon("x", "y", "edges")).collect()}
    assert got == {(0.5, 0.5), (-8.75, 30.55)}
    geo = json.loads(GJ.polygons_table(f).first().geometry)
    assert geo == {"type": "MultiPolygon", "coordinates": parts}
