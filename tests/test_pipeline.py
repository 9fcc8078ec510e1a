import pytest

from terrascore import catalog
from terrascore.plans import pipeline as PL
from terrascore.plans import testdata as TD
from terrascore.plans.quality import ChecksFailed
from terrascore.sources.tables import seed_thresholds

SF = "/root/testdata/sf0.001"


def _build(spark, **kw):
    return PL.build_all(spark, catalog.TEST_CFG.with_(**kw.pop("cfg", {})), TD.polygon_features(spark, SF),
                        TD.pixels(spark, SF), TD.static_pixels(spark, SF), seed_thresholds(spark), **kw)


def test_build_into_catalog_tables_is_idempotent(spark):
    dbs = dict(raw_db="t_raw", staging_db="t_stg", intermediate_db="t_int", marts_db="t_marts")
    first = _build(spark, cfg=dbs)
    n1 = spark.table("t_raw.ndvi_raw").count()
    a1 = sorted(map(tuple, spark.table("t_marts.assessment_dataset").collect()), key=repr)
    second = _build(spark, cfg=dbs)
    assert spark.table("t_raw.ndvi_raw").count() == n1 == first["ndvi_raw"] == second["ndvi_raw"]
    assert sorted(map(tuple, spark.table("t_marts.assessment_dataset").collect()), key=repr) == a1
    assert spark.table("t_stg.stg_ndvi").count() == n1 and spark.table("t_stg.stg_soil").count() == first["soil_raw"]
    q = first["quality"]
    assert q["fact_unique_field_date"] == 0 and q["fact_scores_in_unit_range"] == 0
    assert q["thresholds_unique_feature_period"] == 0 and q["dim_location_unique_field"] == 0


def test_plain_append_duplicates_on_rerun(spark):
    dbs = dict(raw_db="t_raw2", staging_db="t_stg2", intermediate_db="t_int2", marts_db="t_marts2", idempotent_loads=False)
    first = _build(spark, cfg=dbs)
    with pytest.raises(ChecksFailed, match="fact_unique_field_date"):
        _build(spark, cfg=dbs)
    assert spark.table("t_raw2.ndvi_raw").count() == 2 * first["ndvi_raw"]
    # the joins multiply duplicated keys (k copies in three series -> k^3 rows)
    assert spark.table("t_int2.int_harmonized_environmental_data").count() > first["ndvi_raw"]


def test_a_longer_period_replaces_the_months_it_shares(spark):
    """A build, and another over a period that begins later and ends a month later: the checks pass, and the series are those of one build."""
    dbs = lambda n: dict(raw_db=f"{n}_raw", staging_db=f"{n}_stg", intermediate_db=f"{n}_int", marts_db=f"{n}_marts")
    _build(spark, cfg=dbs("t_a") | dict(start_date="1995-01-01", end_date="1997-01-01"))
    _build(spark, cfg=dbs("t_a") | dict(start_date="1996-01-01", end_date="1997-02-01"))
    _build(spark, cfg=dbs("t_b") | dict(start_date="1995-01-01", end_date="1997-02-01"))
    for name in ("ndvi", "temperature", "rainfall"):
        a, b = (sorted((r.field_id, str(r.date), r[name]) for r in spark.table(f"{n}_raw.{name}_raw").collect()) for n in ("t_a", "t_b"))
        assert a == b and a
