from pyspark.sql import functions as F

from terrascore import catalog
from terrascore.plans import testdata as TD
from terrascore.plans.extract import extract_series
from terrascore.session import scratch_path
from terrascore.streaming.incremental import read_series, start_series_stream

SF = "/root/testdata/sf0.001"


def test_incremental_stream_equals_batch(spark):
    cfg = catalog.TEST_CFG
    spec = TD.TEST_SERIES[0]
    px = TD.pixels(spark, SF)
    src, out = scratch_path(spark, "px-stream"), scratch_path(spark, "ndvi-stream")
    idx = catalog.index(spark, SF)
    # first drop: images before 1998; second drop: the rest (months overlap nowhere)
    px.filter(F.col("image_date") < "1998-01-01").write.parquet(src, mode="append")
    start_series_stream(spark, src, idx, spec, cfg, out).awaitTermination()
    px.filter(F.col("image_date") >= "1998-01-01").write.parquet(src, mode="append")
    start_series_stream(spark, src, idx, spec, cfg, out).awaitTermination()
    # replaying a month must not duplicate it
    px.filter(F.col("image_date").between("1998-03-01", "1998-03-31")).limit(1).write.parquet(src, mode="append")
    start_series_stream(spark, src, idx, spec, cfg, out).awaitTermination()
    got = read_series(spark, out, "ndvi")
    want = extract_series(spark, spark.read.parquet(src), idx, spec, cfg)
    r = lambda df: sorted((x.field_id, x.date, round(x.ndvi, 9)) for x in df.collect())
    assert r(got) == r(want)


def test_refresh_prunes_month_partitions(spark):
    from terrascore.sources.tables import write_pixels
    from terrascore.streaming.incremental import refresh_months
    cfg, spec = catalog.TEST_CFG, TD.TEST_SERIES[2]
    src, out = scratch_path(spark, "px-layout"), scratch_path(spark, "rain-refresh")
    write_pixels(TD.pixels(spark, SF), src)
    full = spark.read.parquet(src)
    touched = full.filter(F.col("image_date").between("1997-03-01", "1997-04-30"))
    idx = catalog.index(spark, SF)
    refresh_months(spark, touched, full, idx, spec, cfg, out)
    got = read_series(spark, out, "rainfall")
    assert {r.date for r in got.select("date").distinct().collect()} <= {"1997-03-01", "1997-04-01"}
    want = extract_series(spark, full.filter(F.col("image_date").between("1997-03-01", "1997-04-30")), idx, spec, cfg)
    r = lambda df: sorted((x.field_id, x.date, round(x.rainfall, 9)) for x in df.collect())
    assert r(got) == r(want)


def test_a_file_that_lands_mid_stream_is_seen(spark):
    """A batch lists the pixel folder when it runs, not when the stream was started."""
    cfg, spec = catalog.TEST_CFG, TD.TEST_SERIES[2]
    src, out = scratch_path(spark, "px-late"), scratch_path(spark, "rain-late")
    idx = catalog.index(spark, SF)
    march = TD.pixels(spark, SF).filter(F.col("image_date").between("1997-03-01", "1997-03-31"))
    march.filter("image_date < '1997-03-10'").coalesce(1).write.parquet(src, mode="append")
    query = start_series_stream(spark, src, idx, spec, cfg, out, available_now=False, interval="1 second")
    try:
        query.processAllAvailable()
        march.filter("image_date >= '1997-03-10'").coalesce(1).write.parquet(src, mode="append")
        query.processAllAvailable()
    finally:
        query.stop()
    got = read_series(spark, out, "rainfall")
    want = extract_series(spark, spark.read.parquet(src), idx, spec, cfg)
    r = lambda df: sorted((x.field_id, x.date, x.rainfall) for x in df.collect())
    assert r(got) == r(want) and r(got)
